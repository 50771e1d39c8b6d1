"""Token counts of whole texts with a public tokenizer file.

The texts of an Arrow batch are cut at safe boundaries, the different pieces are encoded by
the tokenizer library in batches of about equal bytes, and only lengths come back.  A single
space between two non-space characters is a safe boundary of a byte-level BPE: no match of
its pre-tokenisation pattern spans that place, the space always opens the next match, and no
special string holds a space.  So a text's count is the sum over its pieces, and a piece that
was encoded before is answered from a bounded memo.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import as_text, field, map_texts

#: Pieces remembered per worker process; pieces longer than MEMO_CHARS are encoded each time.
MEMO_PIECES = 1_000_000
MEMO_CHARS = 48
#: Characters in one joined text, and texts of that size in one library call.
JOINED_CHARS = 4096
CALL_TEXTS = 64

# Python's \S is stricter than the Unicode White_Space property (it also excludes the
# separators U+001C-U+001F), so every boundary found here is safe
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_FIRST = "| |"


class PieceCounter:
    """``counts(texts)``: tokens per text as the library gives them."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark owns the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        """Library lengths of ``pieces``.  Pieces that open with the boundary's space are joined
        to texts of about equal size (their joints are safe boundaries again) and each token
        falls to the piece that holds its start; other pieces are texts of their own."""
        out = np.zeros(len(pieces), np.int64)
        texts: list[tuple[str, list[int]]] = []
        held: list[int] = []
        chars = 0
        for i, p in enumerate(pieces):
            # only a piece with a space in front and none at its end has safe joints
            if len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace():
                held.append(i)
                chars += len(p)
                if chars >= JOINED_CHARS:
                    texts.append(("".join([pieces[j] for j in held]), held))
                    held, chars = [], 0
            else:
                texts.append((p, [i]))
        if held:
            texts.append(("".join([pieces[j] for j in held]), held))
        for k in range(0, len(texts), CALL_TEXTS):
            part = texts[k:k + CALL_TEXTS]
            for e, (_, own) in zip(self.tokenizer.encode_batch([t for t, _ in part], add_special_tokens=False),
                                   part, strict=True):
                if len(own) == 1:
                    out[own[0]] = len(e)
                else:
                    starts = np.cumsum([0] + [len(pieces[j]) for j in own[:-1]])
                    at = np.searchsorted(starts, [s for s, _ in e.offsets], side="right") - 1
                    out[own] = np.bincount(at, minlength=len(own))
        return out.tolist()

    def counts(self, texts: list[str]) -> list[int]:
        memo = self.memo
        split = [_SAFE.split(t) for t in texts]
        new: set[str] = set()
        for parts in split:
            # every piece but the first opens with the boundary's space; the memo holds those
            # without it, and a first piece behind a mark that holds a boundary, as no piece does
            parts[0] = _FIRST + parts[0]
            new.update(parts)
        todo = [p for p in new if p not in memo]
        real = [p[len(_FIRST):] if p.startswith(_FIRST) else " " + p for p in todo]
        found = dict(zip(todo, self.lengths(real), strict=True))
        if len(memo) < MEMO_PIECES:
            # until the memo is full; what comes first is mostly what is frequent
            memo.update((p, n) for p, n in found.items() if len(p) <= MEMO_CHARS)
            found = {p: n for p, n in found.items() if len(p) > MEMO_CHARS}
        if found:
            return [sum([memo[p] if p in memo else found[p] for p in parts]) for parts in split]
        get = memo.__getitem__
        return [sum(map(get, parts)) for parts in split]


@lru_cache(1)
def counter(tokenizer_path: str) -> PieceCounter:
    """One counter a worker process: its memo serves all tasks the process runs."""
    return PieceCounter(tokenizer_path)


class _Kernel:
    def __init__(self, tokenizer_path: str):
        self.counter = counter(tokenizer_path)

    def __call__(self, values: pa.Array):
        texts = as_text(values)
        return [len(t.encode()) for t in texts], self.counter.counts(texts)


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) with n_bytes and n_tokens of the whole text.

    A null text counts as empty (0 bytes, 0 tokens); very long texts are cut at safe
    boundaries only, whole runs without one are encoded whole; repeated rows are counted each;
    an empty table gives an empty result; columns named n_bytes or n_tokens are replaced.
    ``tokenizer_path`` must name a byte-level BPE file of the tokenizers library, present on
    every executor.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    return map_texts(docs, text_col, partial(_Kernel, tokenizer_path),
                     [field("n_bytes", "long"), field("n_tokens", "long")], keep)
