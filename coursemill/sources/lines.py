"""Text logs to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemill.functions import cleaning as C
from coursemill.sources.specs import FieldSpec, TableSpec

CORRUPT = "_corrupt"
#: Where the numbers of read and rejected lines go.
Observed = Observation | str | None

RECIPES = {
    "register_source": C.register_source_name,
    "mask_name": C.mask_name,
    "mask_phone": C.mask_phone,
    "mask_const": lambda _: C.mask_const(),
}


def read_lines(spark: SparkSession, path: str, min_parts: int | None = None) -> DataFrame:
    """One row per text line, in a column named ``value``."""
    lines = spark.read.text(path)
    # A file too small to be split is spread out on request only: Spark already
    # cuts large files by spark.sql.files.maxPartitionBytes.
    return lines.repartition(min_parts) if min_parts else lines


def _raw_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names + [CORRUPT]])


def parse_json(lines: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse every line once, all fields as text; lines that are no object keep ``_corrupt``.

    Parsing happens inside a generator so that a later filter on its output
    cannot be pushed below it and make Spark parse every line twice.
    """
    parsed = F.from_json("value", _raw_schema(names),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    filled = lines.where(F.length(F.trim("value")) > 0)
    return filled.select(*[F.col(k) for k in keep], F.inline(F.array(parsed)))


def drop_bad_json(lines: DataFrame, names: list[str], keep: tuple[str, ...] = (), observe: Observed = None) -> DataFrame:
    """Rows of the lines that hold a JSON object; everything else is dropped.

    ``observe`` counts ``lines`` and ``rejected`` lines while they are read, without a scan of their own: an
    ``Observation`` for a batch; for a stream a name, under which each progress report has the two numbers.
    """
    rows = parse_json(lines, names, keep)
    if observe is not None:
        rows = rows.observe(observe, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected"))
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_json_lines(lines: DataFrame) -> DataFrame:
    """The non-blank lines ``drop_bad_json`` rejects, for a rejects table."""
    return parse_json(lines, ["_"]).where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def _typed(f: FieldSpec) -> Column:
    raw = F.coalesce(*[F.col(s) for s in f.spellings]) if len(f.spellings) > 1 else F.col(f.name)
    kind = {
        "int": C.int_or_zero,
        "decimal": C.decimal_half_up,
        "long": C.long_or_null,
        "text_or_empty": C.string_or_empty,
        "text": lambda c: c,
    }[f.kind]
    return kind(raw).alias(f.name)


def json_lines_to_table(lines: DataFrame, spec: TableSpec, observe: Observed = None) -> DataFrame:
    """Log lines to the table a spec describes: drop bad lines, type, derive. ``observe`` as in ``drop_bad_json``."""
    names = [s for f in spec.fields for s in f.spellings]
    rows = drop_bad_json(lines, names, observe=observe).select(*[_typed(f) for f in spec.fields])
    derived = {c: RECIPES[recipe](F.col(src) if src else None) for c, recipe, src in spec.derived}
    return rows.withColumns(derived).select(*spec.columns)


def bad_field_counts(lines: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: how many values of each whole-number field were no number."""
    ints = [f for f in spec.fields if f.kind == "int"]
    names = [s for f in spec.fields for s in f.spellings]
    rows = drop_bad_json(lines, names)
    return rows.agg(*[F.count_if(C.is_bad_int(F.coalesce(*[F.col(s) for s in f.spellings]))).alias(f.name)
                      for f in ints])


def tsv_fields(lines: DataFrame, names: list[str], keep: tuple[str, ...] = (), observe: Observed = None) -> DataFrame:
    """Tab-separated lines with exactly ``len(names)`` fields; others are dropped, and counted by ``observe`` as in ``drop_bad_json``.

    Blank fields at the end of a line do not count, as in the JVM's own split.
    """
    parts = F.split(F.regexp_replace("value", "\t+$", ""), "\t")
    fits = F.coalesce(F.size(parts) == len(names), F.lit(False))
    if observe is not None:
        lines = lines.observe(observe, F.count(F.lit(1)).alias("lines"), F.count_if(~fits).alias("rejected"))
    good = lines.where(fits)
    return good.select(*[F.col(k) for k in keep], *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
