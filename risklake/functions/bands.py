"""Bands and lookups of the risk rules."""

from pyspark.sql import Column, functions as F

# Lowest score, income and delay of each band, highest first, and the band below all of them.
SCORE_BANDS = [(750, "BAIXO"), (600, "MEDIO"), (500, "ALTO")]
SCORE_REST = "MUITO_ALTO"
INCOME_BANDS = [(10000.0, "ALTA"), (5000.0, "MEDIA"), (2000.0, "BAIXA")]
INCOME_REST = "MUITO_BAIXA"
DELAY_POINTS = [(60, 30), (30, 15)]
DELAY_REST = 5
# Severity of each event type.
SEVERITY = {"ATRASO_30": 1, "ATRASO_60": 2, "ATRASO_90": 3, "CALOTE": 4}

ACTIVE, SETTLED, DEFAULTED = "ATIVO", "QUITADO", "INADIMPLENTE"
LOAN_STATUSES = [ACTIVE, SETTLED, DEFAULTED]


def _first_match(cases: list[tuple[Column, object]], rest: object) -> Column:
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(rest))


def score_band(score: Column) -> Column:
    return _first_match([(score >= low, band) for low, band in SCORE_BANDS], SCORE_REST)


def income_band(income: Column) -> Column:
    """Income band; a missing income is in the lowest band."""
    return _first_match([(income >= low, band) for low, band in INCOME_BANDS], INCOME_REST)


def delay_points(days: Column) -> Column:
    return _first_match([(days > low, points) for low, points in DELAY_POINTS], DELAY_REST)


def severity(event_type: Column) -> Column:
    """Severity of an event type as written; 0 for an unknown or missing type."""
    known = [(event_type == name, level) for name, level in SEVERITY.items()]
    return _first_match(known, 0).cast("long")
