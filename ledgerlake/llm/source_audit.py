"""How the vocabulary of each source differs from the other sources and from its language.

Counting is a sort of pointers: in a slice of texts every place where a word starts is a pointer
into the Arrow text buffer, and a multikey quicksort orders the pointers by the words they stand
at, eight bytes at a time.  Equal words become one run; its pointers, still in order of group and
text, give the documents and the occurrences of the word by (language, source).  A task sends one
row a slice, group and word, so frequent words are added up before the shuffle.  On the way a
group is a number, a hash that is checked to tell all of them apart.

Counts move once, by language and word: the task that adds them up also decides which words are
kept and writes a row a word with its counts by group.  The rest is SQL over these rows: smoothed
shares in whole billionths, and the divergence of every pair of sources.

A pair's sum runs over all kept words, most of which occur in few sources.  It is the sum over
the words of either source against the other's share for an absent word, grouped by equal
counts, plus a correction from the words that occur in both, which a task adds up for a block of
words before it sends one row a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.common import byte_slices, ident, set_arrow_rows
from ledgerlake.session import cut_lineage

#: Documents of its language that a word needs, shares in units of one billionth, ranks of words.
MIN_DOCS = 3
UNITS = 1_000_000_000
TOP_TERMS = 200
#: Bytes of text sorted together (a longer text is sorted in pieces), pointers below which a slice
#: is sorted by its keys at once, rows of one Arrow batch of counts.
SORT_BYTES = 8 << 20
OUT_ROWS = 1 << 16
SHORT_SLICE = 1 << 20
#: Words of one block of pair sums.
BLOCK_TERMS = 1 << 14

_WORD = np.zeros(256, bool)
_WORD[ord("A"):ord("Z") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
# keeps the first n bytes of a big-endian word of eight
_HEAD = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


class Pointers:
    """Words of a byte buffer: start and length of each, in text order, and their keys."""

    def __init__(self, text: np.ndarray, breaks: np.ndarray):
        """``breaks``: first byte of every document; a word never runs over one."""
        size = text.size
        self.bytes = np.zeros(size + 8, np.uint8)
        self.bytes[:size] = _LOWER[text]
        # eight bytes from every place on, without a copy
        self.eights = np.ndarray(size + 1, "V8", self.bytes, strides=(1,))
        inside = _WORD[text]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        at = breaks[breaks < size]
        first[at] = inside[at]
        at = at[at > 0] - 1
        last[at] = inside[at]
        self.start = np.flatnonzero(first).astype(np.int32)
        self.length = np.flatnonzero(last).astype(np.int32) + np.int32(1) - self.start

    def key(self, p: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of each word from ``depth`` on as one number, zeros past its end."""
        at = np.minimum(self.start[p] + np.int32(depth), np.int32(self.eights.size - 1))     # words that are over read nothing
        left = np.clip(self.length[p] - np.int32(depth), 0, 8)
        return self.eights[at].view(">u8").astype(np.uint64) & _HEAD[left]

    def sorted(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pointers ordered by word (equal words in the given order), and whether each one starts
        a run of equal words.

        Multikey quicksort: a slice is split by its keys at one depth into less, equal and
        greater than a pivot; the equal part goes on eight bytes deeper.  Keys move along with
        their pointers, so they are read once a depth.  Short slices are finished by key sorts,
        all their groups of equal keys at once.
        """
        p = p.astype(np.int32)
        keys = self.key(p, 0)
        run = np.zeros(p.size, bool)
        todo = [(0, p.size, 0)] if p.size else []
        while todo:
            lo, hi, depth = todo.pop()
            part, key = p[lo:hi], keys[lo:hi]
            if hi - lo <= SHORT_SLICE:
                self._finish(part, run[lo:hi], key, depth)
                continue
            sample = np.sort(key[::max(1, key.size // 31)])
            pivot = sample[sample.size // 2]
            less, more = key < pivot, key > pivot
            order = np.concatenate([np.flatnonzero(less), np.flatnonzero(~(less | more)), np.flatnonzero(more)])
            i, j = lo + int(less.sum()), hi - int(more.sum())
            p[lo:hi], keys[lo:hi] = part[order], key[order]
            if i > lo:
                todo.append((lo, i, depth))
            if j < hi:
                todo.append((j, hi, depth))
            run[i] = True
            if (self.length[p[i:j]] > depth + 8).any():
                keys[i:j] = self.key(p[i:j], depth + 8)
                todo.append((i, j, depth + 8))
        return p, run

    def _finish(self, part: np.ndarray, run: np.ndarray, keys: np.ndarray, depth: int) -> None:
        """Sort a short slice in place, its words equal up to ``depth``, where ``keys`` are read."""
        order = np.argsort(keys, kind="stable")
        part[:] = part[order]
        keys = keys[order]
        new = np.ones(part.size, bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.arange(part.size)                # places still to be ordered, in groups
        while True:
            run[at[new]] = True
            # groups of equal keys with a word that goes on
            group = np.cumsum(new) - 1
            depth += 8
            longer = np.bincount(group, self.length[part[at]] > depth) > 0
            on = (longer & (np.bincount(group) > 1))[group]
            at, group = at[on], group[on]
            if not at.size:
                return
            keys = self.key(part[at], depth)
            order = np.lexsort((keys, group))
            part[at] = part[at][order]
            keys, group = keys[order], group[order]
            new = np.ones(at.size, bool)
            new[1:] = (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])


def _group_numbers(columns: list[pa.Array]) -> tuple[np.ndarray, list[pa.Array]]:
    """Number of each row's (language, source), and the values by number."""
    codes = [c.dictionary_encode() for c in columns]
    a, b = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
    width = max(len(codes[1].dictionary), 1)
    pairs, group = np.unique(a * width + b, return_inverse=True)
    return group, [codes[0].dictionary.take(pa.array(pairs // width)), codes[1].dictionary.take(pa.array(pairs % width))]


def count_slice(text: pa.Array, lang: pa.Array, source: pa.Array):
    """(lang, source, term, docs, n) arrays of one slice of texts (no nulls)."""
    text = text.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    buffer = whole[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    words = Pointers(buffer, np.unique(offsets[:-1]))
    group, (langs, sources) = _group_numbers([lang, source])
    none = np.zeros(0, np.int64)
    if not words.start.size:
        return langs.slice(0, 0), sources.slice(0, 0), pa.array([], pa.string()), none, none
    # pointers start out by group, and equal words keep that order: a group's share of a run, and a
    # document's share of that, are neighbours
    many = np.diff(np.searchsorted(words.start, offsets))
    by_group = np.argsort(group, kind="stable")
    before = np.cumsum(many) - many
    own = many[by_group]
    p = np.repeat(before[by_group] - (np.cumsum(own) - own), own) + np.arange(words.start.size)
    doc = np.repeat(np.arange(len(many), dtype=np.int32), many)
    order, run = words.sorted(p)
    doc = doc[order]
    g = group.astype(np.int32)[doc]
    new = run.copy()
    new[1:] |= g[1:] != g[:-1]
    new_doc = new.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    n = np.diff(at, append=order.size)
    docs = np.add.reduceat(new_doc, at, dtype=np.int64)
    # the words as one Arrow array: lengths to offsets, bytes gathered once a run
    head = order[run]
    size = words.length[head]
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    take = np.repeat(words.start[head] - ends[:-1], size) + np.arange(ends[-1])
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(head), [
        None, pa.py_buffer(ends.tobytes()), pa.py_buffer(words.bytes[take].tobytes())]).cast(pa.large_string())
    terms = terms.take(pa.array(np.cumsum(run)[at] - 1))
    g = pa.array(g[at])
    return langs.take(g), sources.take(g), terms.cast(pa.string()), docs, n


def text_bytes(texts: pa.Array) -> int:
    return int(pc.sum(pc.binary_length(texts)).as_py() or 0)


def text_pieces(text: pa.Array, size: int):
    """A single text in pieces of about ``size`` bytes, cut before bytes that are in no word."""
    data = np.frombuffer(text.cast(pa.large_binary())[0].as_buffer(), np.uint8)
    at = 0
    while at < data.size:
        end = min(at + size, data.size)
        while end < data.size and _WORD[data[end]]:      # a word goes on: to the end of it, block by block
            more = np.flatnonzero(~_WORD[data[end:end + 4096]])
            end += int(more[0]) if more.size else min(4096, data.size - end)
        yield pa.array([data[at:end].tobytes()], pa.large_binary())
        at = end


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, docs, n): documents and occurrences of every word of every group."""
    rows = docs.select(_filled(text_col).alias("text"), _filled(lang_col).alias("lang"), _filled(source_col).alias("source"))
    return _counts(rows, ["lang", "source", "term"])


def _filled(name: str):
    return F.coalesce(ident(name).cast("string"), F.lit(""))


def _counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts of (text, lang, source) rows without nulls, languages and sources as names or as
    numbers; partitioned by language and word, so that what is kept of a word is decided in place.

    A slice's counts are sent as they are: words of the long tail differ from slice to slice, so
    adding up before the exchange costs more than it saves."""
    set_arrow_rows(rows.sparkSession)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("lang", "source")]
    schema = T._parse_datatype_string(f"lang {kinds[0]}, source {kinds[1]}, term string, docs long, n long")
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def counted(text, lang, source):
        a, b, t, d, n = count_slice(text, lang, source)
        return [pa.array(x).cast(kind) for x, kind in zip((a, b, t, d, n), types, strict=True)]

    def flush(held):
        table = pa.Table.from_batches(held).combine_chunks()
        for batch in table.to_batches():
            whole = pa.RecordBatch.from_arrays(counted(*batch.columns), names=schema.names)
            for lo in range(0, whole.num_rows, OUT_ROWS):
                yield whole.slice(lo, OUT_ROWS)

    def long_text(row):
        """One text beyond a slice: its pieces are sorted one by one and count as one document."""
        parts = [pa.table(counted(piece, row.column(1), row.column(2)), names=schema.names)
                 for piece in text_pieces(row.column(0), SORT_BYTES)]
        whole = pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum")])
        ones = pa.array(np.ones(whole.num_rows, np.int64))
        yield from pa.table([whole["lang"], whole["source"], whole["term"], ones, whole["n_sum"]],
                            names=schema.names).to_batches(max_chunksize=OUT_ROWS)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in byte_slices(batch, 0, SORT_BYTES):
                own = text_bytes(part.column(0))
                if own > SORT_BYTES:                     # a slice of one text
                    yield from long_text(part)
                    continue
                if size + own > SORT_BYTES:
                    yield from flush(held)
                    held, size = [], 0
                held.append(part)
                size += own
        if held:
            yield from flush(held)

    return (rows.mapInArrow(run, schema).repartition("lang", "term").groupBy(*by)
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))


def _numbered_groups(docs: DataFrame, lang_col: str, source_col: str) -> tuple[DataFrame, int]:
    """(lang, source, l, g), a row a group: numbers of the languages and of the groups, and the
    seed of the hash they come from, for which different names have different numbers."""
    names = docs.select(_filled(lang_col).alias("lang"), _filled(source_col).alias("source")).distinct()
    names = cut_lineage(names, "audit-names")
    for seed in range(100):
        found = names.select("lang", "source", *_numbers("lang", "source", seed))
        n = found.agg(F.count(F.lit(1)), F.count_distinct("g"), F.count_distinct("lang"), F.count_distinct("l")).first()
        if n[0] == n[1] and n[2] == n[3]:
            return found, seed
    raise RuntimeError("no hash tells all languages and sources apart")


def _numbers(lang, source, seed: int) -> list:
    return [F.xxhash64(F.lit(seed), lang).alias("l"), F.xxhash64(F.lit(seed), lang, source).alias("g")]


def _kept_words(batches, min_docs: int):
    """Words with enough documents, a row each with its counts by group, from counts that are
    sorted by word and language.  A run of equal words that a block ends in waits for the next."""
    def words(table, last):
        """Rows of the whole runs of a block, and how many cells they are."""
        term, lang = table["term"].chunk(0), table["lang"].chunk(0).to_numpy()
        new = np.ones(len(term), bool)
        new[1:] = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        new[1:] |= lang[1:] != lang[:-1]
        at = np.flatnonzero(new)
        done = len(term) if last else int(at[-1])
        if not done:
            return None, 0
        at = at[at < done]
        docs, n = (table[c].chunk(0).to_numpy()[:done] for c in ("docs", "n"))
        size = np.diff(at, append=done)
        keep = np.add.reduceat(docs, at) >= min_docs
        cell = pa.array(np.flatnonzero(np.repeat(keep, size)))
        ends = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([table["source"].chunk(0).take(cell), table["n"].chunk(0).take(cell)], names=["g", "n"])
        return pa.RecordBatch.from_arrays([pa.array(lang[at[keep]]), term.take(pa.array(at[keep])), pa.array(np.add.reduceat(n, at)[keep]),
                                           pa.ListArray.from_arrays(pa.array(ends), pairs)], names=["l", "term", "lang_n", "at"]), done

    held, size, limit = [], 0, OUT_ROWS
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= limit:
            whole = pa.Table.from_batches(held).combine_chunks()
            found, done = words(whole, False)
            if done:
                yield found
            held = whole.slice(done).combine_chunks().to_batches()
            size -= done
            limit = max(OUT_ROWS, 2 * size)
    if held:
        yield words(pa.Table.from_batches(held).combine_chunks(), True)[0]


def _share(n: str, total: str, terms: str) -> str:
    """1 + floor(UNITS * (n + 1) / (total + terms)), exact for any counts."""
    return (f"1L + if({n} < {(1 << 63) // UNITS - 1}L, ({UNITS}L * ({n} + 1L)) div ({total} + {terms}),"
            f" (cast({UNITS} as decimal(10,0)) * cast({n} + 1L as decimal(20,0)))"
            f" div cast({total} + {terms} as decimal(20,0)))")


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` compares each source with every
    other source of its language, part ``term`` lists the words a source has more of than its
    language, ``top_terms`` at most.

    Null text, language and source are the empty string.  A group without words takes part with
    no counts; a language whose words are all rare has values of 0 and no terms.  Repeated rows
    are documents of their own; an empty table gives an empty result; other columns are not read.
    """
    groups, seed = _numbered_groups(docs, lang_col, source_col)
    number = _numbers(_filled(lang_col), _filled(source_col), seed)
    rows = docs.select(_filled(text_col).alias("text"), number[0].alias("lang"), number[1].alias("source"))
    counted = _counts(rows, ["lang", "term", "source"]).sortWithinPartitions("term", "lang")
    # a row a kept word: what follows needs no exchange of words
    kept = cut_lineage(counted.mapInArrow(lambda batches: _kept_words(batches, min_docs),
                                          "l long, term string, lang_n long, at array<struct<g: long, n: long>>"), "audit-kept")
    cells = kept.select("term", "lang_n", F.inline("at"))
    counts = cut_lineage(cells.groupBy("g", "n").agg(F.count(F.lit(1)).alias("k")), "audit-counts")
    terms = kept.groupBy("l").agg(F.count(F.lit(1)).alias("V"), F.sum("lang_n").alias("lang_total"))
    # one row a group: its total, words that occur in it, share of a word that does not
    sums = counts.groupBy("g").agg(F.sum(F.expr("n * k")).alias("total"), F.sum("k").alias("held"))
    zero = F.lit(0).cast("long")
    facts = (groups.join(sums, "g", "left").join(terms, "l", "left")
             .select("lang", "source", "l", "g", *[F.coalesce(c, zero).alias(c) for c in ("total", "held", "V", "lang_total")])
             .withColumn("absent", F.when(F.col("V") > 0, F.expr(_share("0L", "total", "V"))).otherwise(F.lit(1).cast("long"))))
    facts = cut_lineage(facts, "audit-groups")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    over = (cells.join(facts.select("g", "total", "V", "lang_total"), "g")
            .select("g", "term", F.expr(_share("n", "total", "V")).alias("p"), F.expr(_share("lang_n", "lang_total", "V")).alias("q"))
            .where("p > q").select("g", F.col("term").alias("item"), F.expr(_gap("p", "q")).alias("value"))
            .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= top_terms)
            .join(facts.select("lang", "source", "g"), "g")
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    pairs = _pairs(kept, counts, facts).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(over)


def _gaps(p, q):
    return (p - q) * (p - q) // q


def _common(batches):
    """Sums over a block of words, by pair of sources, of the words that both have: their gap less
    the gaps of each against the other's share of an absent word."""
    def flush(held):
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        lang = batch.column(0).dictionary_encode()
        at = batch.column(1)
        flat = at.flatten()
        row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
        source = flat.field(0).dictionary_encode()
        name = source.indices.to_numpy()
        p, absent = flat.field(1).to_numpy(), flat.field(2).to_numpy()
        of = lang.indices.to_numpy()[row]
        for code in range(len(lang.dictionary)):
            e = np.flatnonzero(of == code)
            names, col = np.unique(name[e], return_inverse=True)
            lines, line = np.unique(row[e], return_inverse=True)
            share = np.zeros((lines.size, names.size), np.int64)
            share[line, col] = p[e]
            p0 = np.zeros(names.size, np.int64)
            p0[col] = absent[e]
            numbers = source.dictionary.take(pa.array(names))
            for g in range(names.size):
                q = share[share[:, g] > 0]
                mine = q[:, g:g + 1]
                has = q > 0
                has[:, g] = False
                q = np.where(has, q, 1)
                fix = _gaps(mine, q) - _gaps(mine, p0) - _gaps(p0[g], q)
                n = has.sum(axis=0)
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [numbers.take(pa.array(np.full(hit.size, g))), numbers.take(pa.array(hit)),
                     pa.array((fix * has).sum(axis=0)[hit], pa.int64()), pa.array(n[hit], pa.int64())],
                    names=["g", "o", "fix", "common"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= BLOCK_TERMS:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def _pairs(kept: DataFrame, counts: DataFrame, facts: DataFrame) -> DataFrame:
    """(lang, source, other, value) of all pairs of different sources of a language."""
    left = facts.select("lang", "source", "l", "g", "V", F.col("held").alias("held_p"), F.col("absent").alias("p0"))
    right = facts.select("l", F.col("g").alias("o"), F.col("source").alias("other"), F.col("held").alias("held_q"), F.col("absent").alias("q0"))
    pair = left.join(right, "l").where("g <> o")       # the rows of the result
    # the words of one source by equal share, each against the other's share of an absent word
    by_share = counts.join(facts.select("l", "g", "total", "V"), "g").select("l", "g", F.expr(_share("n", "total", "V")).alias("p"), "k")
    mine = (by_share.join(right.select("l", "o", "q0"), "l").where("g <> o").groupBy("g", "o")
            .agg(F.sum(F.expr(f"k * ({_gap('p', 'q0')})")).alias("mine")))
    theirs = (by_share.select("l", F.col("g").alias("o"), F.col("p").alias("q"), "k").join(left.select("l", "g", "p0"), "l")
              .where("g <> o").groupBy("g", "o").agg(F.sum(F.expr(f"k * ({_gap('p0', 'q')})")).alias("theirs")))
    # words of both: true distance instead of the two against an absent word; a language's groups
    # come to its words as one map
    book = cut_lineage(facts.where("held > 0").groupBy("l").agg(
        F.first("V").alias("V"), F.map_from_entries(F.collect_list(F.struct("g", F.struct("total", "absent")))).alias("of")), "audit-book")
    at = f"transform(at, x -> struct(x.g as source, {_share('x.n', 'of[x.g].total', 'V')} as p, of[x.g].absent as absent))"
    held = kept.where(F.size("at") > 1).join(book, "l").select("l", F.expr(at).alias("at"))
    both = (held.mapInArrow(_common, "g long, o long, fix long, common long")
            .groupBy("g", "o").agg(F.sum("fix").alias("fix"), F.sum("common").alias("common")))
    on = ["g", "o"]
    zero = F.lit(0).cast("long")
    out = pair.join(mine, on, "left").join(theirs, on, "left").join(both, on, "left")
    parts = [F.coalesce(c, zero) for c in ("mine", "theirs", "fix")]
    neither = F.col("V") - F.col("held_p") - F.col("held_q") + F.coalesce("common", zero)
    return out.select("lang", "source", "other", (parts[0] + parts[1] + parts[2] + neither * F.expr(_gap("p0", "q0"))).alias("value"))
