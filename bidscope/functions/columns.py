"""Column expressions (JVM-side, codegen'd).  No Python UDFs here.

Each function returns a ``Column`` so callers can compose them inside one
``select``/``withColumns`` and keep a single whole-stage-codegen span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Advance-rate bins (right-closed edges) and their labels.
TAUX_AVANCE_EDGES = [-0.001, 0.001, 0.05, 0.15, 1.0]
TAUX_AVANCE_LABELS = ["no_advance", "small_advance", "medium_advance", "large_advance"]
# Amount ranges [lo, hi) of the estimation model.
AMOUNT_RANGES = [(0.0, 25000.0), (25000.0, 90000.0), (90000.0, 221000.0),
                 (221000.0, 1000000.0), (1000000.0, math.inf)]
# Prevalence (percent) -> status, and detection factor -> status.
PREVALENCE_STATUS = [(10.0, "Very High"), (5.0, "High"), (1.0, "Medium"), (0.1, "Low")]
PREVALENCE_DEFAULT = "Very Low"
DETECTION_STATUS = [(2.0, "Excellent"), (1.5, "Good"), (0.8, "Weak")]
DETECTION_DEFAULT = "Poor"
# CPV divisions refined to level 3 by ``cpv_2_3``.
CPV_2_3_DIVISIONS = ["45000000", "71000000"]
# Names that reports show for features: whole names, and the start of a one-hot name by column.
READABLE = {
    "offres_recues_pipeline__offresRecues": "Nombre offres reçues", "other_num_pipeline__montant": "Montant (€)",
    "other_num_pipeline__dureeMois": "Durée (mois)", "binary_pipeline__sousTraitanceDeclaree": "Sous-traitance déclarée",
    "binary_pipeline__origineFrance": "Origine France", "binary_pipeline__marcheInnovant": "Marché innovant",
    "binary_pipeline__idAccordCadre": "Accord cadre"}
READABLE_LEVELS = {"procedure": "Procédure", "nature": "Nature", "formePrix": "Forme prix", "ccag": "CCAG", "codeCPV_2_3": "CPV"}
# ---------------------------------------------------------------------------

_U_SCALE = 268435456.0  # 16**7: seven hex digits of an md5 → [0, 1)


def dbl(x: float) -> Column:
    return F.lit(float(x))


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- CPV codes
def cpv_level(code, level: int) -> Column:
    """First ``level`` digits of the 8-digit code, right-padded with zeros.

    trim → text before '-' → right-pad to 8 with '0' → keep ``level`` digits →
    right-pad to 8.  Null stays null.
    """
    if not 2 <= level <= 5:
        raise ValueError("Level must be between 2 and 5")
    numeric = F.split_part(F.trim(col_or(code)), F.lit("-"), F.lit(1))
    padded = F.concat(numeric, F.lit("00000000"))  # right-pad without truncating
    return F.rpad(F.substring(padded, 1, level), 8, "0")


def cpv_2_3(code) -> Column:
    """Level 3 inside the construction/engineering divisions, else level 2."""
    l2 = cpv_level(code, 2)
    return F.when(l2.isin(*CPV_2_3_DIVISIONS), cpv_level(code, 3)).otherwise(l2)


def cpv_code_from_part() -> Column:
    """Synthetic CPV code of a part: DD SS PPPP - C (see SURVEY §1.1)."""
    brand = F.substring("p_brand", 7, 8).cast("int")
    division = F.when(brand == 25, F.lit(71)).otherwise(F.lit(44) + brand)
    return F.concat(
        division.cast("string"),
        F.lpad(F.col("p_size").cast("string"), 2, "0"),
        F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"),
        F.lit("-"),
        (F.col("p_partkey") % 10).cast("string"))


# ------------------------------------------------- deterministic randomness
def md5_key(*parts, seed) -> Column:
    """md5 of ``part1:part2:...:seed``; identical strings in Spark and SQL."""
    cols = [col_or(p) for p in parts] + [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *cols))


def md5_uniform(*parts, seed) -> Column:
    """Uniform [0,1) draw from the first 7 hex digits of ``md5_key``."""
    h = md5_key(*parts, seed=seed)
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("double") / dbl(_U_SCALE)


def uniform_between(lo: float, hi: float, *parts, seed) -> Column:
    return dbl(lo) + md5_uniform(*parts, seed=seed) * dbl(hi - lo)


# --------------------------------------------------------------- binning
def bin_fixed(c, edges=TAUX_AVANCE_EDGES, labels=TAUX_AVANCE_LABELS) -> Column:
    """Right-closed bins (e0,e1], (e1,e2], ...; outside or null → null."""
    x = col_or(c)
    out = F.lit(None).cast("string")
    for i in reversed(range(len(labels))):
        out = F.when((x > dbl(edges[i])) & (x <= dbl(edges[i + 1])), F.lit(labels[i])).otherwise(out)
    return out


def bin_ranges(c, ranges=AMOUNT_RANGES) -> Column:
    """Index of the first [lo,hi) containing the value; else the last class."""
    x = col_or(c)
    last = len(ranges) - 1
    out = F.lit(last)
    for i in reversed(range(len(ranges))):
        lo, hi = ranges[i]
        cond = x >= dbl(lo)
        if not math.isinf(hi):
            cond = cond & (x < dbl(hi))
        out = F.when(cond, F.lit(i)).otherwise(out)
    return F.coalesce(out, F.lit(last))


def bin_equal_width(y, lo: Column, hi: Column, n: int) -> Column:
    """``pd.cut(y, linspace(lo, hi, n+1), include_lowest=True)`` codes 0..n-1."""
    width = (hi - lo) / dbl(n)
    raw = F.ceil((col_or(y) - lo) / width) - F.lit(1)
    return F.least(F.greatest(raw, F.lit(0)), F.lit(n - 1)).cast("int")


def status_from_thresholds(x, thresholds, default: str) -> Column:
    """First label whose threshold is strictly exceeded, else ``default``."""
    v = col_or(x)
    out = F.lit(default)
    for thr, label in reversed(thresholds):
        out = F.when(v > dbl(thr), F.lit(label)).otherwise(out)
    return out


def prevalence_status(pct) -> Column:
    return status_from_thresholds(pct, PREVALENCE_STATUS, PREVALENCE_DEFAULT)


def detection_status(factor) -> Column:
    return status_from_thresholds(factor, DETECTION_STATUS, DETECTION_DEFAULT)


def title_name(c) -> Column:
    """``name.replace('_', ' ').title()`` for snake_case identifiers."""
    return F.initcap(F.regexp_replace(col_or(c), "_", " "))


def truncate_label(c, n: int = 23) -> Column:
    """First ``n`` characters plus '...' when longer than ``n``."""
    x = col_or(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


# ------------------------------------------------------------ dates, nulls
def parse_date(c) -> Column:
    """``to_datetime(errors='coerce')``: bad text → null; years outside the
    pandas timestamp range (1677–2262) → null as well."""
    d = F.try_to_date(col_or(c), "yyyy-MM-dd")
    y = F.year(d)
    return F.when((y >= 1678) & (y <= 2261), d)


def year_of(c) -> Column:
    """Integer year from the first four characters; bad text → null."""
    return F.substring(col_or(c), 1, 4).try_cast("int")


def notnull_flag(c) -> Column:
    return col_or(c).isNotNull().cast("int")


def log1p_clip_inverse(c, lo: float = 0.0, hi: float = 20.0) -> Column:
    return F.expm1(F.least(F.greatest(col_or(c), dbl(lo)), dbl(hi)))


def pct(num, den) -> Column:
    """100·num/den as double; 0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(col_or(num).cast("double") * dbl(100), col_or(den).cast("double")), dbl(0))


def readable_feature(name: Column) -> Column:
    """The name that a report shows for a feature; others keep their own."""
    out = name
    for column, shown in READABLE_LEVELS.items():
        start = f"cat_pipeline__{column}_"
        out = F.when(name.startswith(start), F.concat(F.lit(f"{shown}: "), F.substring(name, len(start) + 1, 1_000_000))).otherwise(out)
    for whole, shown in READABLE.items():
        out = F.when(name == whole, F.lit(shown)).otherwise(out)
    return out
