"""Column expressions for the scalar rules.

Every helper takes and returns a ``Column`` and is built only from
``pyspark.sql.functions`` so it stays inside whole-stage codegen.  They are
the per-row parts of the DataFrame jobs in ``florapipe.operators``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values that must equal the source pipeline's ---------------------
# Binomial pattern: capitalised genus, whitespace, lower-case epithet.
BINOMIAL_PATTERN = r"^([A-Z][a-zA-Z-]+)\s+([a-z-]+)"
HYBRID_SIGN = "×"          # the multiplication sign used for hybrids
NOT_FOUND_TEXT = "Description not found."
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
             "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
             "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: ColumnOrName) -> Column:
    """Strip all Unicode whitespace at both ends (Python ``str.strip``)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def first_nonblank(*cols: ColumnOrName) -> Column:
    """``a or b or ...`` over text: the first non-NULL, non-empty value."""
    return F.coalesce(*[F.when(col(c) != "", col(c)) for c in cols])


def _binomial_from(cleaned: Column) -> Column:
    g = F.regexp_extract(cleaned, "(?U)" + BINOMIAL_PATTERN, 1)
    s = F.regexp_extract(cleaned, "(?U)" + BINOMIAL_PATTERN, 2)
    return F.when(g != "", F.concat_ws(" ", g, s))


def extract_binomial(c: ColumnOrName) -> Column:
    """hybrid sign to space, strip, leading "Genus epithet" or NULL."""
    c = col(c)
    cleaned = ustrip(F.replace(c, F.lit(HYBRID_SIGN), F.lit(" ")))
    return F.when(c != "", _binomial_from(cleaned))


def normalize_query_name(c: ColumnOrName) -> Column:
    """as F1 but " x " hybrid markers are removed first."""
    c = col(c)
    cleaned = ustrip(F.replace(F.replace(c, F.lit(HYBRID_SIGN), F.lit(" ")),
                               F.lit(" x "), F.lit(" ")))
    return F.when(c != "", _binomial_from(cleaned))


def is_valid_species_name(c: ColumnOrName) -> Column:
    """NULL, "x" and names containing " x " are invalid.

    A whitespace-only name is invalid too: it would become a NULL key once
    cleaned (kept as a fix, see README)."""
    n = F.lower(ustrip(col(c)))
    return F.coalesce((n != "") & (n != "x") & ~F.contains(n, F.lit(" x ")),
                      F.lit(False))


def clean_common_name(c: ColumnOrName) -> Column:
    """strip, lower-case, upper-case the first character only."""
    s = F.lower(ustrip(col(c)))
    return F.coalesce(F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30)),
                      F.lit(""))


def _tokens(c: ColumnOrName) -> Column:
    return F.split(ustrip(col(c)), r"(?U)\s+")


def species_epithet(c: ColumnOrName) -> Column:
    """second whitespace token or ""."""
    return F.coalesce(F.try_element_at(_tokens(c), F.lit(2)), F.lit(""))


def genus_token(c: ColumnOrName) -> Column:
    """text before the first single space (``name.split(" ")[0]``)."""
    return F.substring_index(col(c), " ", 1)


def first_tokens(c: ColumnOrName, n: int = 2) -> Column:
    """the first n whitespace tokens joined by one space."""
    return F.array_join(F.slice(_tokens(c), 1, n), " ")


def page_title(c: ColumnOrName) -> Column:
    """F8: spaces to underscores."""
    return F.replace(col(c), F.lit(" "), F.lit("_"))


def lower_source(c: ColumnOrName) -> Column:
    """trim and lower-case; NULL stays NULL."""
    return F.lower(ustrip(col(c)))


def tolerant_bigint(c: ColumnOrName) -> Column:
    """integer from text such as "12345" or "12345.0"; else NULL."""
    s = ustrip(col(c).cast("string"))
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))


def truthy(c: ColumnOrName) -> Column:
    """"true" in any case."""
    return F.coalesce(F.lower(col(c).cast("string")) == "true", F.lit(False))


def photo_url(large: ColumnOrName, medium: ColumnOrName, square: ColumnOrName) -> Column:
    """large, else medium, else square (empty counts as missing)."""
    return first_nonblank(large, medium, square)


def common_name_fallback(*cols: ColumnOrName) -> Column:
    """first non-empty candidate, else ""."""
    return F.coalesce(first_nonblank(*cols), F.lit(""))


def fallback_observation(reason: ColumnOrName) -> Column:
    """the observation struct used when a lookup yields nothing."""
    return F.struct(F.lit(None).cast("bigint").alias("inat_id"),
                    F.lit(None).cast("bigint").alias("observations"),
                    F.array().cast("array<string>").alias("images"),
                    F.lit("").alias("common_name"),
                    col(reason).alias("inat_status"))


def description_pair(text: ColumnOrName, source: ColumnOrName) -> Column:
    """(text, source) struct, with the not-found pair as default."""
    return F.struct(F.coalesce(col(text), F.lit(NOT_FOUND_TEXT)).alias("description"),
                    F.coalesce(col(source), F.lit("none")).alias("source"))


def extraction_time() -> Column:
    """F16: wall-clock stamp of the run (never part of comparisons)."""
    return F.current_timestamp()


def json_list(c: ColumnOrName) -> Column:
    """array to JSON text, only at a CSV edge."""
    return F.to_json(col(c))


def blank_placeholder() -> Column:
    """empty text for columns the source never fills."""
    return F.lit("")


def clean_text(c: ColumnOrName) -> Column:
    """P2 rule: strip; blank and any-case "nan" become NULL."""
    s = ustrip(col(c).cast("string"))
    return F.when((s != "") & (F.lower(s) != "nan"), s)


def na_to_null(c: ColumnOrName) -> Column:
    """CSV reader rule: the default NA tokens of the source's reader are NULL."""
    c = col(c)
    return F.when(~c.isin(NA_TOKENS), c)


def normalize_media_url(c: ColumnOrName, drop_query: bool = True) -> Column:
    """P5: thumbnail to medium size; optionally drop the query string."""
    u = F.replace(col(c), F.lit("square"), F.lit("medium"))
    return F.substring_index(u, "?", 1) if drop_query else u


def parse_json_list(c: ColumnOrName, element: str = "string") -> Column:
    """NULL or malformed JSON list text becomes an empty list."""
    return F.coalesce(F.from_json(col(c), f"array<{element}>"),
                      F.array().cast(f"array<{element}>"))


def first_of(a: ColumnOrName, b: ColumnOrName) -> Column:
    """M5: first element of a, else first element of b, else NULL."""
    return F.coalesce(F.try_element_at(col(a), F.lit(1)), F.try_element_at(col(b), F.lit(1)))
