"""Record-level jobs: name standardisation, cleaning, schema enforcement,
typed projections, rejects, assembly (P1-P4, P8, P10-P12, J9)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.functions.expr import (NOT_FOUND_TEXT, clean_common_name, clean_text, common_name_fallback,
                                      description_pair, extract_binomial, extraction_time, first_of, is_valid_species_name, lower_source,
                                      normalize_query_name, parse_json_list, species_epithet, tolerant_bigint,
                                      truthy)


def standardize_names(df: DataFrame, name_col: str) -> DataFrame:
    """``binomial`` (F1), ``query_name`` (F2), ``is_valid`` (F3) and
    ``reject_reason`` (``invalid_name`` for rows a load would skip).

    A projection: nothing moves, and no name is hot."""
    valid = F.coalesce(is_valid_species_name(name_col), F.lit(False))
    return df.select("*", extract_binomial(name_col).alias("binomial"), normalize_query_name(name_col).alias("query_name"),
                     valid.alias("is_valid"), F.when(~valid, F.lit("invalid_name")).alias("reject_reason"))


def clean_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strip; blank and any-case "nan" become NULL; text cast -- one select."""
    return df.select(*[clean_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def normalize_headers(df: DataFrame) -> DataFrame:
    """P10: lower-case and strip every column name; a collision is an error."""
    new = [c.strip().lower() for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after normalising: {new}")
    return df.toDF(*new)


def parse_json_arrays(df: DataFrame, cols: Sequence[str], element: str = "string",
                      flag_suffix: str = "_malformed") -> DataFrame:
    """JSON list text -> arrays; NULL or malformed -> []; a boolean
    ``<col>_malformed`` marks text that did not parse (the reject report is a
    filter on it)."""
    out = df
    for c in cols:
        parsed = F.from_json(F.col(c), f"array<{element}>")
        out = out.withColumn(c + flag_suffix, F.col(c).isNotNull() & parsed.isNull()) \
                 .withColumn(c, parse_json_list(c, element))
    return out


@dataclass(frozen=True)
class Field:
    """One field of an enforced schema."""
    name: str
    dtype: str
    default: object = None
    required: bool = False
    transform: Callable[[Column], Column] | None = None


JSON_TYPES = {"string": ["STRING"], "boolean": ["BOOLEAN"], "tinyint": ["BIGINT"], "smallint": ["BIGINT"],
              "int": ["BIGINT"], "bigint": ["BIGINT"], "float": ["BIGINT", "DOUBLE", "DECIMAL"],
              "double": ["BIGINT", "DOUBLE", "DECIMAL"]}


def _typed_field(doc: Column, name: str, dtype: str) -> Column:
    """A field of a variant if its own type fits ``dtype``, else NULL."""
    path = f"$['{name}']"
    wanted = JSON_TYPES.get(dtype.lower(), ["ARRAY" if dtype.lower().startswith("array") else "OBJECT"])
    kind = F.regexp_extract(F.schema_of_variant(F.try_variant_get(doc, path, "variant")), "^[A-Z]+", 0)
    return F.when(kind.isin(wanted), F.try_variant_get(doc, path, dtype))


def enforce_schema(df: DataFrame, spec: Sequence[Field], json_col: str | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the fields of ``spec``: a missing field or a value of the
    wrong type takes the default, then the transform runs (a NULL result --
    a failed ``try_*`` -- takes the default), a required NULL takes the
    default; unknown columns are dropped.

    With ``json_col`` the fields come from that JSON text, parsed once: a
    malformed document or a value of another JSON type (a number in a text
    field, say) is NULL and leaves the other fields alone.  ``keep`` columns
    pass through unchanged (row identity)."""
    if json_col:
        src = df.withColumn("_doc", F.try_parse_json(json_col))
        get = {f.name: _typed_field(F.col("_doc"), f.name, f.dtype) for f in spec}
    else:
        src = df
        get = {f.name: F.col(f.name).try_cast(f.dtype) for f in spec if f.name in df.columns}
    out = []
    for f in spec:
        default = F.lit(f.default).cast(f.dtype)
        v = F.coalesce(get[f.name], default) if f.name in get else default
        if f.transform is not None:
            v = F.coalesce(f.transform(v), default)
        if f.required:
            v = F.coalesce(v, default)
        out.append(v.alias(f.name))
    return src.select(*keep, *out)


def to_species_rows(df: DataFrame, name_col: str = "scientific_name") -> DataFrame:
    """The 14 typed columns of the parent table from merged rows; rows
    with an invalid name are left out (see :func:`standardize_names`)."""
    c = {x: F.col(x) for x in df.columns}

    def opt(x, expr):
        return expr if x in c else F.lit(None).cast("string")
    ds = clean_text("description_source") if "description_source" in c else F.lit(None).cast("string")
    return (df.filter(is_valid_species_name(name_col))
            .select(clean_text(name_col).alias("scientific_name"),
                    (F.col("common_names") if "common_names" in c else F.array().cast("array<string>"))
                    .alias("common_names"),
                    opt("family", clean_text("family")).alias("family"),
                    opt("wikipedia_description", clean_text("wikipedia_description")).alias("description"),
                    (F.col("primary_image_url") if "primary_image_url" in c
                     else first_of("inat_research_images", "wiki_images")).alias("primary_image_url"),
                    opt("order", clean_text("order")).alias("order_name"),
                    opt("genus", clean_text("genus")).alias("genus"),
                    opt("species", clean_text("species")).alias("species"),
                    tolerant_bigint("gbif_id").alias("gbif_id"),
                    tolerant_bigint("inat_id").alias("inat_id"),
                    tolerant_bigint("observation_count").alias("observation_count"),
                    opt("inat_status", clean_text("inat_status")).alias("inat_status"),
                    truthy("has_images").alias("has_images"),
                    lower_source(ds).alias("description_source")))


def missing_field_rejects(df: DataFrame, key: str = "scientific_name",
                          fields: Sequence[str] = ("family", "species")) -> DataFrame:
    """Rows lacking any of ``fields`` (they are still loaded) -- a side
    report with one flag per field."""
    miss = [F.col(f).isNull().alias(f"missing_{f}") for f in fields]
    cond = None
    for f in fields:
        cond = F.col(f).isNull() if cond is None else cond | F.col(f).isNull()
    return df.filter(cond).select(key, *miss)


def is_complete(df: DataFrame, image_cols: Sequence[str] = ("inat_research_images", "wiki_images", "images"),
                description: str = "wikipedia_description", common_name: str = "common_name",
                out: str = "is_complete") -> DataFrame:
    """At least one image in any list, or a real description, or a common
    name.  Every image list counts (the source looked at one key only)."""
    has_img = F.lit(False)
    for c in image_cols:
        if c in df.columns:
            has_img = has_img | (F.size(F.coalesce(F.col(c), F.array())) > 0)
    desc = F.coalesce((F.col(description) != "") & (F.col(description) != NOT_FOUND_TEXT), F.lit(False)) \
        if description in df.columns else F.lit(False)
    cn = F.coalesce(F.col(common_name) != "", F.lit(False)) if common_name in df.columns else F.lit(False)
    return df.withColumn(out, has_img | desc | cn)


def assemble_records(taxa: DataFrame, key: str, enrichments: Mapping[str, DataFrame],
                     keep: Sequence[str] = ()) -> DataFrame:
    """One species record per taxon row -- the enrichment tables (each at
    most one row per ``key``: "obs", "text", "media") left-joined on the key,
    with the source's defaults.

    taxa: key, order, family, genus, scientific_name, canonical_name,
    vernacular; obs: inat_id, observation_count, common_name, research_images,
    needs_id_images, inat_status; text: description, description_source;
    media: wiki_images.  All joins are on ``key``, so the taxa side is
    exchanged once and the enrichments (already aggregated by key) line up.
    ``keep``: more columns of ``taxa`` to carry (its row position).

    An enrichment is never broadcast: lists and texts that repeat are small as
    files or shuffled blocks, by which Spark measures, and large as rows."""
    out = taxa
    for name in ("obs", "text", "media"):
        if name in enrichments:
            out = out.join(enrichments[name].hint("merge"), key, "left")
    cols = set(out.columns)

    def get(c, default):
        return F.coalesce(F.col(c), default) if c in cols else default
    empty = F.array().cast("array<string>")
    research = get("research_images", empty)
    wiki = get("wiki_images", empty)
    canonical = get("canonical_name", F.lit(""))
    none = F.lit(None).cast("string")
    pair = description_pair(get("description", none), get("description_source", none))
    return out.select(
        get("order", F.lit("")).alias("order"),
        get("family", F.lit("")).alias("family"),
        get("genus", F.lit("")).alias("genus"),
        species_epithet(canonical).alias("species"),
        get("scientific_name", F.lit("")).alias("scientific_name"),
        clean_common_name(common_name_fallback(get("common_name", F.lit("")),
                                               get("vernacular", F.lit("")))).alias("common_name"),
        F.coalesce(F.col(key).try_cast("bigint"), F.lit(0).cast("bigint")).alias("gbif_id"),
        get("inat_id", F.lit(None).cast("bigint")).alias("inat_id"),
        get("inat_status", F.lit("unknown")).alias("inat_status"),
        ((F.size(research) > 0) | (F.size(wiki) > 0)).alias("has_images"),
        get("observation_count", F.lit(None).cast("bigint")).alias("observation_count"),
        pair["description"].alias("wikipedia_description"), pair["source"].alias("description_source"),
        extraction_time().alias("extraction_timestamp"),
        research.alias("inat_research_images"),
        get("needs_id_images", empty).alias("inat_needs_id_images"),
        wiki.alias("wiki_images"), *keep)
