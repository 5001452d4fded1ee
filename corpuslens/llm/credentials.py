"""Secret scans that link the parts of a credential.

Base kinds are found by their patterns. Weaker candidates (names of accounts, key-like strings,
addresses of services) mean nothing alone; an interval join within each text brings
together access identifiers, secrets and endpoints that lie in one scope, and only those
that complement each other are reported. A text is scanned where it is read, whole; nothing
is shuffled.

Defined results: a null text is empty and has no span. Places are code points, ends exclusive.
Spans are ordered by start, then kind (``credential_tasks.KINDS``), then end; a text's spans
do not depend on other rows, so ties, repeated rows and null doc_ids need no rule. ``scan``
keeps the columns of its input, replacing one named ``scan``; ``redact`` returns the input's
columns, and empty texts and nulls stay as they are. An empty table gives no row.
"""

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import credential_tasks

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(credential_tasks)

SPANS = "array<struct<kind:string,start:int,end:int>>"


def found_in(text: Column) -> Column:
    """``struct<base, spans>``: spans of the base kinds, and these with the linked ones."""

    @F.arrow_udf(f"struct<base:{SPANS},spans:{SPANS}>")
    def scanned(texts: pa.Array) -> pa.Array:
        return credential_tasks.scanned(texts)

    return scanned(text)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``scan``."""
    return docs.withColumn("scan", found_in(F.col("text")))


def told(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with a mask for each run of overlapping spans. One pass over the spans."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"), F.lit(False).alias("masked"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        apart = (span["start"] > state["at"]) | ~state["masked"]
        out = F.when(apart, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"])
        return F.struct(
            out.alias("out"), F.greatest(state["at"], span["end"]).alias("at"), F.lit(True).alias("masked")
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)))
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, its columns, with the spans masked in ``text`` and ``n_chars`` recounted where
    something was masked."""
    rows = docs.select(F.struct("*").alias("document"), found_in(F.col("text")).alias("scan"))
    spans = F.col("scan.spans")
    masked = rows.select("document", spans.alias("spans"), redacted(F.col("document.text"), spans).alias("masked"))
    changed = F.size("spans") > 0

    def column(name: str) -> Column:
        own = F.col("document")[name]
        if name == "text":
            return F.col("masked").alias(name)
        if name == "n_chars":
            counted = F.length("masked").cast(dict(docs.dtypes)[name])
            return F.when(changed, counted).otherwise(own).alias(name)
        return own.alias(name)

    return masked.select(*map(column, docs.columns))


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text")
    base = F.col("scan.base")

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("scan.spans")).alias("spans"),
    )
