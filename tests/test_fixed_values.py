"""The rule constants that queries and their SQL share, against values stated here: a wrong one in the
library would be wrong on both sides of every comparison with SQL."""

import re

import pytest

from ledgerlake.plans import gold, silver

# --- fixed values ------------------------------------------------------------------
STATED = {
    "SF_PRODUCTS": {"EMISION SF SIN FIRMA", "RENOVACION SF SIN FIRMA", "SF SIN FIRMA", "SF CON FIRMA", "RENOVACION SF", "EMISION SF"},
    "SIGNATURE_PRODUCTS": {"EMISION", "RENOVACION"},
    "NO_SELLER_CODES": {"0", "28", "123", "NO"},
    "PLAN_NAMES": {("25 TRANSACC", "PLAN MINI"), ("75 TRANSACC", "PLAN BASICO"), ("150 TRANSACC", "PLAN ESENCIAL"),
                   ("350 TRANSACC", "PLAN ESTANDAR"), ("PLAN ILIMITADO", "PLAN PREMIUM")},
    "AGREEMENT_MARKERS": {"ALIANZA", "COLEGIOABOGADO", "ANAMER", "FEUE"},
    "COMMERCIAL_COMMENT_PREFIXES": {"COEMRCIAL", "COMERCIAL"},
}
GOLD = {"AGREEMENT_GROUP": "GRUPO CONVENIOS", "DISTRIBUTOR_GROUP": "GRUPO DISTRIBUIDORES", "AGENT_GROUP": "GRUPO AGENTES", "THIRD_PARTY_GROUP": "GRUPO TERCEROS",
        "VOIDED": "ANULADO", "INVOICED": "FACTURADO"}
# -----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", STATED)
def test_lists(name):
    found = getattr(silver, name)
    assert set(found) == STATED[name] and len(found) == len(STATED[name])


def test_single_values():
    assert silver.DEFAULT_SELLER == "1001"
    assert silver.NO_DISCOUNT_CODE == "SIN CODIGO DE DESCUENTO"
    assert silver.EXTRA_VOUCHERS_CODE == "SF.CA.MANUAL"
    assert {n: getattr(gold, n) for n in GOLD} == GOLD
    assert set(gold.THIRD_PARTY_FAMILIES) == {"FIRMAS ELECTRONICAS", "SISTEMA DE FACTURACION"}


@pytest.mark.parametrize("text, term", [
    ("FIRMA ELEC 1 ANO", "1 ANO"), ("FIRMA 2 ANOS X", "2 ANOS"), ("X 6 MESES", "6 MESES"), ("1 MES", "1 MES"), ("3  SEMANAS", "3  SEMANAS"),
    ("1 SEMANA", "1 SEMANA"), ("ANO 2", None), ("DOS ANOS", None), ("12MESES", None), ("", None)])
def test_terms(spark, text, term):
    """The longest spelling wins, as in a leftmost-longest engine."""
    assert _first(silver.TERM_PATTERN, text) == term
    assert _spark_first(spark, silver.TERM_PATTERN, text) == term


@pytest.mark.parametrize("text, plan", [
    ("FACT 25 TRANSACCIONES", "25 TRANSACC"), ("PLAN ILIMITADO FACT", "PLAN ILIMITADO"), ("PLAN  ILIMITADO", "PLAN  ILIMITADO"),
    ("TRANSACC", None), ("ILIMITADO", None), ("75  TRANSACC", "75  TRANSACC")])
def test_plans(spark, text, plan):
    assert _first(silver.PLAN_PATTERN, text) == plan
    assert _spark_first(spark, silver.PLAN_PATTERN, text) == plan


@pytest.mark.parametrize("text, extra", [("ADICIONAL 50 COMPROBANTES", True), ("ADICIONAL  50 COMPROBANTES", False),
                                         ("X ADICIONAL 50 COMPROBANTES", False), ("ADICIONAL 50 COMPROBANTES.", False),
                                         ("ADICIONAL COMPROBANTES", False)])
def test_extra_vouchers(text, extra):
    assert bool(re.search(silver.EXTRA_VOUCHERS_PATTERN, text)) == extra


def _first(pattern, text):
    found = re.search(pattern, text)
    return found.group(1) if found else None


def _spark_first(spark, pattern, text):
    from ledgerlake.functions import text as text_functions
    return spark.createDataFrame([(text,)], "s string").select(text_functions.regex_extract_or_null("s", pattern)).first()[0]
