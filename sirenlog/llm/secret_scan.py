"""Secret scans over a ledger of blobs.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger remembers which (blob, rule, rule version) triples were scanned; a scan
reads only blobs with a pair that is not there, runs only the missing rules on
them, and joins the findings of all runs back to every path that holds the
blob.  Columns only: everything is DataFrame functions.

A match is found by splitting the text at the pattern: the lengths of the
pieces and of the matches add up to code-point positions.

Defined results: a null text is the empty blob; an empty table gives no rows;
repeated rows are each reported; a document's other columns are kept, and
columns of the input that carry a name of the result are replaced by it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm.common import new_folder


@dataclass(frozen=True)
class Rule:
    """``value_group`` is the group whose length must reach ``least``; ``version`` rises with every change."""

    kind: str
    version: int
    pattern: str
    value_group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values of the contract; the order is the order of kinds at equal starts.
RULES = (
    Rule("assign", 1,
         r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A match of AKIA[A-Z0-9]+ or [0-9a-f]+ reaches to the end of its run of letters, so a
    # too short one holds no longer one: asking for the length in the pattern finds the same
    # and spares the short runs that every word has.
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
SCANS = T.StructType([T.StructField("blob_id", T.StringType()), T.StructField("rules", T.ArrayType(T.StringType())),
                      T.StructField("run", T.StringType())])
FINDINGS = T.StructType([
    T.StructField("blob_id", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("run", T.StringType())])
REDACTED = "[SECRET]"


class BlobLedger:
    """Scanned (blob, rule version) pairs and findings, as Parquet folders in a shared place.

    A run writes its findings first and its scans last; findings of a run whose
    scans are missing do not count, so a broken run is simply scanned again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def scans(self) -> DataFrame:
        return self._table("scans", SCANS)

    def findings(self, rules=RULES) -> DataFrame:
        """Findings of the given rule versions, from completed runs."""
        done = self.scans().select("blob_id", "run").distinct()
        found = self._table("findings", FINDINGS).filter(F.col("rule").isin([r.key for r in rules]))
        return found.join(done, ["blob_id", "run"], "left_semi")

    def scan(self, versions: DataFrame, text: str = "text", rules=RULES) -> int:
        """Scan what is unseen; gives the number of blobs scanned."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        blobs = versions.select(blob_id(F.col(text)).alias("blob_id"), F.coalesce(text, F.lit("")).alias("text"))
        seen = self.scans().select("blob_id", F.explode("rules").alias("rule")).groupBy("blob_id").agg(
            F.collect_set("rule").alias("seen"))
        pending = blobs.dropDuplicates(["blob_id"]).join(seen, "blob_id", "left").withColumn(
            "rules", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        ).filter(F.size("rules") > 0)
        run = uuid.uuid4().hex
        # One pass writes both: a blob without findings leaves a row without a rule.
        scanned = new_folder(self.spark, "secret-scan")
        pending.select("blob_id", "rules", F.filter(
            F.array(*[_matches(r) for r in rules]), lambda m: F.size(m["lengths"]) > 0).alias("found")
        ).write.parquet(scanned)
        raw = self.spark.read.parquet(scanned)
        _positions(raw).select("blob_id", "rule", "start", "end", F.lit(run).alias("run")).write.mode(
            "append").parquet(f"{self.root}/findings")
        raw.select("blob_id", "rules", F.lit(run).alias("run")).write.mode("append").parquet(f"{self.root}/scans")
        return raw.count()


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _matches(rule: Rule) -> Column:
    """The lengths of pieces and matches of a pending rule, and which matches are long enough."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    due = F.array_contains("rules", rule.key) & text.rlike(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = whole if rule.value_group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.value_group))
    lengths = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(whole)), F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda piece, m: F.struct(
            F.char_length(piece).alias("gap"), F.char_length(m["w"]).alias("width"),
            (F.char_length(m["v"]) >= rule.least).alias("fits")))
    none = F.array().cast("array<struct<gap:int,width:int,fits:boolean>>")
    return F.struct(F.lit(rule.key).alias("rule"), F.when(due, lengths).otherwise(none).alias("lengths"))


def _positions(raw: DataFrame) -> DataFrame:
    """Start and end (code points, end exclusive) of each fitting match."""
    each = raw.select("blob_id", F.explode("found").alias("f")).select(
        "blob_id", F.col("f.rule").alias("rule"), F.posexplode("f.lengths").alias("at", "m"))
    order = Window.partitionBy("blob_id", "rule").orderBy("at")
    end = F.sum((F.col("m.gap") + F.col("m.width")).cast("bigint")).over(order)
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.col("m.width")).filter("m.fits")


def by_blob(findings: DataFrame, rules=RULES) -> DataFrame:
    """One row per blob with findings: counts, and the spans in order of start, then kind."""
    ranks = {r.key: i for i, r in enumerate(rules)}
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    rank = F.create_map(*[x for k, i in ranks.items() for x in (F.lit(k), F.lit(i))])
    # ``prior`` is where the spans before reach to, so that a text can be cut without walking back.
    findings = findings.withColumn("rank", rank[F.col("rule")]).withColumn("prior", F.coalesce(F.max("end").over(
        Window.partitionBy("blob_id").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("bigint")))
    spans = F.array_sort(F.collect_list(F.struct("start", "rank", "end", kinds[F.col("rule")].alias("kind"), "prior")))
    counts = [F.count(F.when(F.col("rule") == r.key, 1)).alias(f"n_{r.kind}") for r in rules]
    return findings.groupBy("blob_id").agg(*counts, spans.alias("found"))


def scan_documents(documents: DataFrame, ledger: BlobLedger, text: str = "text", rules=RULES) -> DataFrame:
    """Every row of the input with its blob id, the counts per kind and the spans.

    Adds ``blob_id``, ``n_<kind>`` for each rule, ``found`` (array of start,
    rank, end, kind, prior).  Call again with the same ledger to scan only new blobs.
    """
    ledger.scan(documents, text, rules)
    return _with_findings(documents.withColumn("blob_id", blob_id(F.col(text))), ledger, rules)


def _with_findings(documents: DataFrame, ledger: BlobLedger, rules) -> DataFrame:
    added = [f"n_{r.kind}" for r in rules] + ["found"]
    joined = documents.drop(*added).join(by_blob(ledger.findings(rules), rules), "blob_id", "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,prior:bigint>>")
    return joined.withColumns({name: F.coalesce(name, F.lit(0).cast("bigint")) for name in added[:-1]}
                              | {"found": F.coalesce("found", none)})


def span_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with every found span replaced; overlapping spans give one replacement."""
    last = F.element_at(found, -1)
    end = F.greatest(last["end"], last["prior"])
    gaps = F.transform(F.filter(found, lambda s: s["start"] >= s["prior"]), lambda s: F.substr(
        text, (s["prior"] + 1).cast("int"), (s["start"] - s["prior"]).cast("int")))
    return F.concat(F.array_join(gaps, REDACTED), F.lit(REDACTED),
                    F.substr(text, (end + 1).cast("int"), F.char_length(text)))


def redact_documents(documents: DataFrame, ledger: BlobLedger, text: str = "text", rules=RULES) -> DataFrame:
    """All rows and columns of the input; texts with findings have them replaced, others are unchanged."""
    rows = documents.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    scanned = scan_documents(rows, ledger, "text", rules)
    changed = F.when(F.size("found") > 0, redacted(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    return scanned.select(*[changed.alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns])
