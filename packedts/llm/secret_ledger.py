"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its bytes. A ledger table keeps, for
each blob, which rule versions have scanned it and the spans they found. A scan reads the
ledger, takes one row per blob that has unseen rules, runs just those rules, and appends the
outcome in one atomic write. Findings are then joined back to every row that holds the blob.

Only DataFrame expressions are used. Spans come from splitting a text at a rule's matches:
lengths of the pieces and of the matches add up to positions in code points.

Scale: one of many equal texts per task survives before the shuffle by blob (the group limit
of the window runs on both sides of it), so copies do not pile up. The join back moves hashes
only, and the findings of a blob are spread over salts.

Defined results: a null text is empty and has no spans; repeated rows each get the findings;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.scratch import scratch_path

SALTS = 16
LEDGER = "blob binary, rules array<string>, spans array<struct<start:int,place:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts (0: the whole match) and the least length.

    near names literals of which a text must hold one, as a cheap test before the pattern.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    near: tuple[str, ...] = field(default=())

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values of the base rules, then the further kinds.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, ("-----BEGIN",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1, ("eyJ",)),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, ("xox",)),
)


def _lengths(text: Column, rule: Rule) -> Column:
    """One struct per match: length of the text before it, of the match, and whether it counts."""
    pattern = F.lit(rule.pattern)
    before = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, 0), F.length)
    counted = whole if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, rule.group), F.length)
    rows = F.transform(
        F.sequence(F.lit(0), F.size(whole) - 1),
        lambda i: F.struct(
            F.get(before, i).alias("gap"), F.get(whole, i).alias("size"), (F.get(counted, i) >= rule.least).alias("counts")
        ),
    )
    found = text.rlike(rule.pattern)
    for k, literal in enumerate(rule.near):
        near = text.contains(literal) if not k else near | text.contains(literal)
    return F.when((near & found) if rule.near else found, rows)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rules (those run now) and spans, one row per row of (blob, text, seen)."""
    run = F.array_except(F.array(*(F.lit(r.key) for r in rules)), "seen")
    matches = F.array(
        *(
            F.struct(
                F.lit(place).alias("place"),
                F.lit(r.kind).alias("kind"),
                F.when(~F.array_contains("seen", r.key), _lengths(F.col("text"), r)).alias("rows"),
            )
            for place, r in enumerate(rules)
        )
    )
    kept = blobs.select("blob", run.alias("rules"), F.filter(matches, lambda m: F.size(F.coalesce(m["rows"], F.array())) > 0).alias("matches"))
    each = kept.select("blob", "rules", F.explode_outer("matches").alias("m")).select("blob", "rules", "m.place", "m.kind", F.posexplode_outer("m.rows").alias("i", "row"))
    order = Window.partitionBy("blob", "place").orderBy("i")
    end = F.sum(F.col("row.gap") + F.col("row.size")).over(order).cast("int")
    spans = each.withColumn("end", end).withColumn("start", (F.col("end") - F.col("row.size")).cast("int"))
    span = F.when(F.col("row.counts"), F.struct("start", "place", "kind", "end"))
    return spans.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list(span)).alias("spans"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(spark: SparkSession, versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the unseen pairs of blob and rule version in versions (column text); the ledger after it.

    The ledger is appended to in one write; a failed run leaves it as it was.
    """
    ledger = read_ledger(spark, path)
    blob = F.unhex(F.sha2(F.col("text"), 256))
    first = Window.partitionBy("blob").orderBy(F.lit(1))
    texts = (
        versions.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .select(blob.alias("blob"), "text")
        .withColumn("copy", F.row_number().over(first))
        .where("copy = 1")
    )
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    unseen = (
        texts.join(seen, "blob", "left")
        .select("blob", "text", F.coalesce("seen", F.array().cast("array<string>")).alias("seen"))
        .where(F.size(F.array_except(F.array(*(F.lit(r.key) for r in rules)), "seen")) > 0)
    )
    scan_blobs(unseen, rules).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and spans of every row of versions, in order of start and rule."""
    place = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))))
    ours = F.array(*(F.lit(r.key) for r in rules))
    each = (
        ledger.where(F.arrays_overlap("rules", ours))
        .select("blob", F.explode("spans").alias("s"))
        .select("blob", "s.start", place[F.col("s.kind")].alias("place"), "s.kind", "s.end")
        .where("place IS NOT NULL")
    )
    per_blob = each.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", "place", "kind", "end"))).alias("spans"))
    salted = per_blob.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = versions.select(
        "doc_id",
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("blob"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
    )
    joined = rows.join(salted, ["blob", "salt"], "left")
    empty = F.array().cast(per_blob.schema["spans"].dataType)
    return joined.select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by a scan into a fresh ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = findings(docs, update_ledger(spark, docs, scratch_path(spark, "secret-ledger")))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(listed(of(*BASE_KINDS)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def _sql(rules: tuple[tuple[str, str, int, int], ...]) -> str:
    per_rule = "\n  UNION ALL ".join(
        f"SELECT id, {place} AS place, '{kind}' AS kind, unnest(regexp_extract_all(text, '{p}', {group})) AS counted,"
        f" unnest(regexp_extract_all(text, '{p}')) AS whole,"
        f" unnest(string_split_regex(text, '{p}')[:len(regexp_extract_all(text, '{p}'))]) AS gap,"
        f" unnest(generate_series(1, len(regexp_extract_all(text, '{p}')))) AS i, {least} AS least FROM docs"
        for place, (kind, p, group, least) in enumerate(rules)
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({per_rule}),
spans AS (
  SELECT *, (sum(length(gap) + length(whole)) OVER (PARTITION BY id, place ORDER BY i))::BIGINT AS e FROM matches
), found AS (
  SELECT id, place, kind, e - length(whole) AS s, e FROM spans WHERE length(counted) >= least
), listed AS (
  SELECT id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
    string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, place) FILTER (place < 3) AS base,
    string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, place) AS spans
  FROM found GROUP BY id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (id)
"""


# RE2 folds letters beyond ASCII under (?i), so the SQL names both cases.
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
OP5_SQL = _sql(
    (
        ("assign", rf"""({_ANY_CASE})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        *((r.kind, r.pattern, 0, r.least) for r in RULES[1:]),
    )
)
