"""Nested JSON documents whose elements are lists of named attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.operators.order import starts_before
from comarca.sources.scratch import scratch_path

# The places where an attribute may hold its value, in order of preference (fixed values).
SLOTS = ("valor", "LocalidadPadre", "string", "text")

ATTRIBUTE_PATH = "document.list.element.attribute"

_ATTRIBUTE = T.StructType(
    [T.StructField(field, T.StringType()) for field in ("name", *SLOTS)]
)
_ELEMENT = T.StructType(
    [
        T.StructField(
            "element",
            T.StructType([T.StructField("attribute", T.ArrayType(_ATTRIBUTE))]),
        )
    ]
)

# ``valor`` is text in some attributes and a list in others; declared as text, a list is
# kept as its JSON source.
ATTRIBUTE_DOCUMENT = T.StructType(
    [
        T.StructField(
            "document",
            T.StructType(
                [
                    T.StructField("date", T.StringType()),
                    T.StructField("list", T.ArrayType(_ELEMENT)),
                ]
            ),
        )
    ]
)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ATTRIBUTE_DOCUMENT,
    whole_file: bool = True,
) -> DataFrame:
    """Read JSON documents under a given schema, without an inference scan.

    With ``whole_file`` a file is one document spanning many lines, read by one task; a
    folder of files is read in parallel. Without it each line is a document and large files
    are split. A document that is no JSON, or has another shape, is an error.
    """
    return spark.read.schema(schema).json(path, multiLine=whole_file, mode="FAILFAST")


# A piece of a file is what stands between two keys "element", or before the first, or after the last.
_KEY = '"element"'
_VALUED = r"^\s*+:"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_BLANKS = " \t\r\n"
# Documents follow each other without a comma; quotes keep this out of texts.
_MEETING = r"\}\s*+\{"
_JOINT = rf"({_STRING})|(\}})\s*+(\{{)"
# Documents down to their elements, which are passed over.
_DOCUMENTS = "array<struct<document:struct<list:array<struct<element:struct<nothing:boolean>>>>>>"


def _judged(pieces: DataFrame) -> DataFrame:
    """Whether each piece holds a value, goes on to the next element, and is sound: JSON between its
    two keys, with every element in a document's list.

    A piece is completed to an array of documents: an open list and an element's key are put before
    a value, an element's value and the closing brackets after a piece that goes on. Spark's
    parser then judges it, whatever other members there are and however deep they are. Nothing
    but the piece itself is needed, so the pieces of one file are judged in parallel. Each step has a
    projection of its own: Catalyst would not see that a parse comes twice in one.
    """
    piece = F.monotonically_increasing_id().alias("piece")
    text = F.when(F.col("value").startswith("\uFEFF"), F.substr("value", F.lit(2))).otherwise(F.col("value"))
    cut = pieces.select("file", "block", piece, text.alias("text"))
    # An open brace or a comma at the end: another element must come.
    end = F.rtrim("text", F.lit(_BLANKS))
    known = cut.select(
        "*", F.col("text").rlike(_VALUED).alias("valued"),
        (end.endswith("{") | end.endswith(",")).alias("goes_on"),
        (F.col("text").contains('"document"') & F.col("text").rlike(_MEETING)).alias("meets"),
    )
    # Where two documents meet a comma is put, and a mark first: a comma of the file is no such place.
    marked = F.when(F.col("meets"), F.regexp_replace("text", _JOINT, "$1$2\u0001$3"))
    meetings = known.select("*", marked.alias("marked")).select(
        "*", F.coalesce(F.regexp_count("marked", F.lit("\\}\u0001\\{")), F.lit(0)).alias("meetings"),
        F.replace(F.regexp_replace("marked", "(?<=\\})\u0001(?=\\{)", ","), F.lit("\u0001"), F.lit("")).alias("parted"),
    )
    before = F.when(F.col("valued"), F.lit('[{"document":{"list":[{"element"')).otherwise(F.lit("["))
    after = F.when(F.col("goes_on"), F.lit('"element":null}]}}]')).otherwise(F.lit("]"))
    whole = F.concat(before, F.coalesce("parted", "text"), after)
    parsed = meetings.select("*", F.from_json(whole, _DOCUMENTS).alias("docs"))
    # The size of a missing list is null.
    sizes = F.transform("docs", lambda d: F.cardinality(d["document"]["list"]))
    counted = parsed.select("*", F.filter(sizes, lambda n: n >= 0).alias("sizes"))
    elements = F.aggregate("sizes", F.lit(0), lambda total, n: total + n)
    sound = (
        (F.size("docs") == F.col("meetings") + 1)
        & (F.size("sizes") == F.size("docs"))
        & (elements == F.col("valued").cast("int") + F.col("goes_on").cast("int"))
    )
    blank = ~F.col("valued") & F.col("text").rlike(r"^\s*+$")
    return counted.select("file", "block", "piece", "valued", "goes_on", (blank | F.coalesce(sound, F.lit(False))).alias("sound"))


def _pieces(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    """The pieces of all files, with the split that each begins in, in its order."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    if whole_files:
        files = spark.read.text(path, wholetext=True).select("value", *place)
        cut = F.explode(F.split("value", _KEY + r"(?=\s*+:)"))
        return files.select(cut.alias("value"), "file", "block")
    return spark.read.text(path, lineSep=_KEY).select("value", *place)


def _splits(pieces: DataFrame) -> DataFrame:
    """One row per split: how many pieces start a file or end one, have another shape, or hold an
    element's value, and the number of the first of these, one following the other.

    A file is whole if one piece starts it, one ends it, and all are sound: then those between
    each close one element and open the next.
    """
    return _judged(pieces).groupBy("file", "block").agg(
        F.count_if(~F.col("valued")).alias("starts"),
        F.count_if(~F.col("goes_on")).alias("ends"),
        F.count_if(~F.col("sound")).alias("strange"),
        F.count_if("valued").alias("elements"),
        # In its task, which may have other splits too.
        F.min(F.when(F.col("valued"), F.col("piece"))).alias("first"),
    )


def _faults(splits: DataFrame) -> tuple[int, str | None]:
    """How many files are not whole documents, and the name of one of them."""
    files = splits.groupBy("file").agg(*[F.sum(name).alias(name) for name in ("starts", "ends", "strange")])
    sound = (F.col("starts") == 1) & (F.col("ends") == 1) & (F.col("strange") == 0)
    found = files.where(~sound).agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    return tuple(found.first())


def read_elements(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """Read just the elements of JSON documents, as one column ``attributes``.

    A file is cut at the key ``"element"``, so one large document is read by many tasks,
    whatever its line breaks and whatever members stand beside the lists and the elements. A
    first job checks that every file is whole: it raises ``ValueError`` for text of another shape,
    for a file cut anywhere and for text after the end. Files may hold several documents; an
    empty file has no elements. Quotes within a JSON text are escaped, hence the key cannot appear
    inside one; if some text is the word itself, the files are read one task per file. The key
    must not be used outside the lists. A broken element is an error when it is read.

    ``position`` names a column that counts the elements from 0, file by file in the order of
    their names and as they stand there. The count does not depend on how files are split: the
    first job counts the elements of each split, sums over the splits before give each
    split's first number. That table has one row per split. The elements must be read under
    the settings for splitting files under which this was called, else reading raises.
    """
    whole_files = False
    pieces = _pieces(spark, path, whole_files)
    splits = _stored(spark, _splits(pieces))
    if _faults(splits)[0]:
        # A text that is the key itself: cut only at keys, which takes a whole file in one task.
        pieces = _pieces(spark, path, whole_files=True)
        splits = _stored(spark, _splits(pieces))
        n, file = _faults(splits)
        if n:
            raise ValueError(f"{n} files of {path} are not whole attribute documents, one is {file}")
    if position is None:
        valued, kept = pieces.where(F.col("value").rlike(_VALUED)), []
    else:
        valued, kept = _positioned(spark, pieces, splits, position), [position]
    # Unpacked as a list of one: filters are not pushed below that, so each is parsed once.
    listed = F.from_json(F.concat(F.lit("{" + _KEY), "value"), T.ArrayType(_ELEMENT), {"mode": "FAILFAST"})
    parsed = valued.select(*kept, F.inline_outer(listed))
    return parsed.select(*kept, F.col("element.attribute").alias("attributes"))


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "splits")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _positioned(spark: SparkSession, pieces: DataFrame, splits: DataFrame, position: str) -> DataFrame:
    """The pieces with a value, numbered through all files."""
    starts = starts_before(splits.where("elements > 0"), "file", "block", "elements")
    starts = _stored(spark, starts.select("file", "block", "start", "first"))
    numbered = pieces.withColumn("piece", F.monotonically_increasing_id())
    placed = numbered.where(F.col("value").rlike(_VALUED)).join(starts, ["file", "block"], "left")
    number = F.col("piece") - F.col("first") + F.col("start")
    moved = F.raise_error(F.lit(f"files are split otherwise than when {position} was counted")).cast("long")
    return placed.select(F.coalesce(number, moved).alias(position), "value")
