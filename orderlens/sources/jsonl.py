"""Strict JSON-lines reading with line numbers, at any size.

A line is trimmed; blank lines are skipped but counted. A line that is valid JSON but not an
object, or not valid JSON at all, is reported with its 1-based number in its load. Errors do
not stop the parse.

One parse a line. The line is put into an array before a second object that carries its hash, and
the array is read with the real schema, every leaf as text so a wrongly typed value never drops the
record. Two entries with the hash in the second prove that the line is one JSON value with nothing
after it: text that ends the array early loses the second entry, and text that adds an entry makes
it more than two. Lines that this parse refuses go through a strict probe of their own
(:func:`whole_json`), which alone decides about them; in an export they are few.

Files are read once. One job reads each split, in file order, classifies its lines and writes them
with the split they came from and their order in it. How many lines come before a split is added up
from what that job wrote, so numbers and lines cannot disagree, however a later scan would cut the
files. The written lines stay until the application ends (``session.scratch`` ends them sooner).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trimmed
from ..session import written_stage

_STRICT = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false",
           "allowNumericLeadingZeros": "false", "allowNonNumericNumbers": "false",
           "allowUnquotedControlChars": "false", "allowBackslashEscapingAnyCharacter": "false"}
PROBE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", **_STRICT}

# The two bad-line messages.
NOT_OBJECT = "Shopify bulk operation JSONL line {n} was not a JSON object."
NOT_JSON = "Shopify bulk operation JSONL line {n} was not valid JSON."

#: Field of the entry behind a line that carries the line's hash.
_SEAL = "__seal"


def schema_of_strings(schema: T.StructType) -> T.StructType:
    """Same shape, every leaf a string (values are typed later with try_cast)."""
    def conv(dt: T.DataType) -> T.DataType:
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, conv(f.dataType), True) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(conv(dt.elementType), True)
        return T.StringType()
    return conv(schema)


def whole_json(t: Column, as_type: str) -> Column:
    """The line is one JSON value of ``as_type`` and nothing follows it."""
    wrapped = F.from_json(F.concat(F.lit('{"w":'), t, F.lit("}")), f"w {as_type}, _corrupt_record string", PROBE_OPTIONS)
    valid = wrapped["_corrupt_record"].isNull() & (F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1)
    if as_type != "string":
        valid = valid & wrapped["w"].isNotNull()
    return F.coalesce(valid, F.lit(False))


def with_object(df: DataFrame, text_col: str, schema: T.StructType | str, is_object: str, value: str) -> DataFrame:
    """``df`` with ``is_object`` (the trimmed text is one JSON object and nothing follows it) and
    ``value`` (read with ``schema``; null unless it is one), by one parse (see the module's text)."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    sealed = T.ArrayType(T.StructType([*wanted.fields, T.StructField(_SEAL, T.StringType())]))
    text, read = F.col(f"__{value}_text"), F.col(f"__{value}_read")
    seal = F.xxhash64(text).cast("string")
    array = F.concat(F.lit("["), text, F.lit(f',{{"{_SEAL}":"'), seal, F.lit('"}]'))
    proven = F.coalesce((F.size(read) == 2) & (F.get(read, 1)[_SEAL] == seal), F.lit(False))
    first = F.get(read, 0)
    taken = F.struct(*[first[f.name].alias(f.name) for f in wanted.fields])
    step = df.withColumn(f"__{value}_text", trimmed(F.col(text_col)))
    step = step.withColumn(f"__{value}_read", F.when(text.startswith("{"), F.from_json(array, sealed, _STRICT)))
    step = step.withColumn(is_object, F.when(proven, F.lit(True)).otherwise(whole_json(text, "struct<_probe:string>")))
    return step.withColumn(value, F.when(proven, taken).when(F.col(is_object), F.from_json(text, wanted, _STRICT))) \
        .drop(f"__{value}_text", f"__{value}_read")


def classified(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """``lines`` with ``kind`` ('record' | 'blank' | 'bad') and ``record`` (``schema`` with text leaves;
    null unless the line is a record)."""
    blank = F.coalesce(trimmed(F.col(value_col)) == "", F.lit(True))
    step = with_object(lines, value_col, schema_of_strings(schema), "__object", "record")
    kind = F.when(F.col("__object"), F.lit("record")).when(blank, F.lit("blank")).otherwise(F.lit("bad"))
    return step.withColumn("kind", kind).drop("__object").select(*lines.columns, "kind", "record")


@dataclass
class ParsedLines:
    """Classified, numbered lines: keys, ``line_no``, the raw text, ``kind`` and ``record``."""

    classified: DataFrame
    number_col: str = "line_no"
    value_col: str = "value"

    def _kept(self) -> list[str]:
        return [c for c in self.classified.columns if c not in ("kind", "record", self.value_col)]

    def _error(self) -> Column:
        n = F.col(self.number_col).cast("string")
        return F.when(whole_json(trimmed(F.col(self.value_col)), "string"), F.replace(F.lit(NOT_OBJECT), F.lit("{n}"), n)).otherwise(
            F.replace(F.lit(NOT_JSON), F.lit("{n}"), n))

    @property
    def lines(self) -> DataFrame:
        """Every line: keys, line_no, raw text, kind, record, and the message of a bad line."""
        return self.classified.withColumn("error", F.when(F.col("kind") == "bad", self._error()))

    def records(self) -> DataFrame:
        """Valid object lines: keys, line_no and the record fields as columns."""
        return self.classified.filter(F.col("kind") == "record").select(*self._kept(), "record.*")

    def bad_lines(self) -> DataFrame:
        return self.classified.filter(F.col("kind") == "bad").select(*self._kept(), self._error().alias("error"))

    def counts(self, keys=()) -> DataFrame:
        """Per load: lines (blank included), records, bad lines, first bad line number."""
        return count_kinds(self.classified.select(*keys, F.col(self.number_col).alias("line_no"), "kind"), keys)


def count_kinds(kinds: DataFrame, keys=()) -> DataFrame:
    return kinds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("kind") == "record").alias("parsed_count"),
        F.count_if(F.col("kind") == "bad").alias("bad_count"),
        F.min(F.when(F.col("kind") == "bad", F.col("line_no"))).alias("first_bad_line"),
    )


def classify_lines(lines: DataFrame, schema: T.StructType, value_col: str = "value",
                   number_col: str = "line_no") -> ParsedLines:
    """S1 on numbered lines: kind, record (typed by ``schema``, leaves as text) and message. The
    result is lazy, and each of its frames parses anew; for several readers write the lines first."""
    return ParsedLines(classified(lines, schema, value_col), number_col, value_col)


# --- files ---------------------------------------------------------------------------------

def placed(text: DataFrame) -> DataFrame:
    """A text-file read with the place of each line: ``file``, ``_block`` (start of its split) and
    ``_mid``, which rises in file order inside a split. All three hold for this one scan."""
    own = {"file": F.col("_metadata.file_path")} if "file" not in text.columns else {}
    block = {"_block": F.col("_metadata.file_block_start")} if "_block" not in text.columns else {}
    return text.select("*", *[c.alias(n) for n, c in {**own, **block}.items()], F.monotonically_increasing_id().alias("_mid"))


def numbered(staged: DataFrame, load_cols=("file",)) -> DataFrame:
    """``line_no`` for written rows of :func:`placed`. Numbers run through the files of a load in name
    order; the place columns go. The offsets (one row per split) are written too, so that Spark knows
    their size when it plans the join and leaves the text where it is."""
    splits = staged.groupBy(*load_cols, *[c for c in ("file", "_block") if c not in load_cols]).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*load_cols).orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("_file"), F.col("_block").alias("_start"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = written_stage(splits, "split-offsets")
    joined = staged.join(offsets, (staged["file"] == offsets["_file"]) & (staged["_block"] == offsets["_start"]))
    number = (F.col("_before") + F.col("_mid") - F.col("_first") + 1).alias("line_no")
    others = [c for c in staged.columns if c not in ("file", "_block", "_mid", *load_cols)]
    return joined.select(*[staged[c] for c in load_cols], *([] if "file" in load_cols else ["file"]), number, *others)


def read_text_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of one or more text files: (file, line_no, value); numbering restarts per file. Reads the
    files once, when it is called."""
    return numbered(written_stage(placed(spark.read.text(path)), "text-lines"))


def stage_lines(text: DataFrame, schema: T.StructType, observation=None, metrics=()) -> DataFrame:
    """The one pass over files: lines placed, classified and written. ``metrics`` (columns over the
    classified lines) are added up into ``observation`` by the same job."""
    lines = classified(placed(text), schema)
    return written_stage(lines.observe(observation, *metrics) if observation is not None else lines, "classified-lines")


def read_bulk_jsonl(spark: SparkSession, path, schema: T.StructType, load_col: str | None = None) -> ParsedLines:
    """S1 over files: ``(records, bad_lines, counts)`` via the returned :class:`ParsedLines`.

    Reads the files once, when it is called, and parses each line once. ``load_col``, a partition
    column of the folder (``load_id=...``), makes all files below one value a load whose lines are
    numbered through; otherwise each file is a load."""
    return ParsedLines(numbered(stage_lines(spark.read.text(path), schema), (load_col,) if load_col else ("file",)))
