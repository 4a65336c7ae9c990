"""URL allow and block rules as a sort-merge range join.

A host is turned round label by label ("www.example.com" -> com, example, www), so that a rule's host and all its
subdomains are one interval of the sorted keys. Pages and rules are dealt to range partitions by key; a rule goes to
every partition that its interval meets. In each partition one sweep over the sorted rows keeps a stack of the rules whose
intervals are open; they are nested, so the innermost are on top. A page takes, from the top, the first rule whose path
starts its own: the longest host wins, then the longest path.

The range bounds come from a sample of ``SAMPLE`` keys per partition (the least hashes); it decides only where rows go.
Equal keys are spread by a hash of the page, so one url, host or path may hold any share of the rows.

Defined results: a null url, or one without "://", has empty host and path and fits no rule; if no rule fits, rule is null
and the verdict is ``default``; of two rules with the same host and path, block wins; rules with a null or empty host fit
nothing, a null path is empty; repeated pages keep a row each; all page columns pass through, and a new column whose name
is taken gets underscores in front.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import ascii_lower, free_name, table

SAMPLE = 20
#: key separators; they sort below every character that a key can have elsewhere
END, LABEL, AFTER = "\x01", "\x02", "\x03"


def _rest(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(F.translate(host, "\x00" + END + LABEL, AFTER * 3), r"\.")), LABEL)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict. rules: (host, path, verdict), of any size."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = {n: free_name(pages, n) for n in ("host", "path", "rule", "verdict")}
    rows = pages.select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(pages.columns)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    spread = F.lpad(F.hex(F.xxhash64("host", "path", *[f"p{i}" for i, c in enumerate(pages.dtypes) if not c[1].startswith("map")])), 16, "0")
    rows = rows.withColumn("key", F.concat(_reversed(F.col("host")), F.lit(END), F.col("path"), F.lit("\x00"), spread))
    sample = [r["key"] for r in rows.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE * parts).collect()]  # bounded
    sample.sort()
    bounds = [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []

    @F.pandas_udf("int")
    def part(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in keys], dtype="int32")

    rules = rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    rules = rules.withColumn("low", F.concat(_reversed(F.col("host")), F.lit(END))).withColumn("high", F.concat(_reversed(F.col("host")), F.lit(AFTER)))
    rules = rules.select("host", "path", "verdict", F.col("low").alias("key"), "high", F.explode(F.sequence(part("low"), part("high"))).alias("part"))
    both = rows.withColumn("part", part("key")).unionByName(rules.withColumn("is_rule", F.lit(1)), allowMissingColumns=True)
    both = both.repartition(parts, "part").sortWithinPartitions("part", "key", F.col("is_rule").desc_nulls_last())
    width = len(pages.columns)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []  # stack: [upper key, host, {path: verdict}, path lengths from the longest]
        for batch in batches:
            get = {n: batch.column(n).to_pylist() for n in ("part", "key", "host", "path", "verdict", "high", "is_rule")}
            mask, rule, verdict = [], [], []
            for p, key, host, path, said, high, is_rule in zip(*get.values()):
                if p != now:
                    now, stack = p, []
                while stack and stack[-1][0] <= key:
                    stack.pop()
                mask.append(not is_rule)
                if is_rule:
                    if not stack or stack[-1][1] != host:
                        stack.append([high, host, {}, []])
                    own = stack[-1][2]
                    own[path] = "block" if own.get(path) == "block" else said
                    stack[-1][3] = sorted({len(x) for x in own}, reverse=True)
                    continue
                found = None
                for _, h, own, lengths in reversed(stack):
                    if host != h and not host.endswith("." + h):
                        continue
                    found = next((path[:n] for n in lengths if path[:n] in own), None)
                    if found is not None:
                        break
                rule.append(None if found is None else h + found)
                verdict.append(default if found is None else own[found])
            kept = batch.filter(pa.array(mask, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*[kept.column(f"p{i}") for i in range(width)], kept.column("host"), kept.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], schema=pa.schema([*[kept.schema.field(f"p{i}") for i in range(width)], ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]))

    schema = both.select(*[f"p{i}" for i in range(width)], "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).schema
    out = both.mapInArrow(sweep, schema)
    return out.select(*[F.col(f"p{i}").alias(c) for i, c in enumerate(pages.columns)], *[F.col(n).alias(a) for n, a in names.items()])


RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


SQL = f"""
with rules(h, p, v) as (values {", ".join(str(r) for r in RULES)}),
u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
k as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u)
select page_id, host, path, h || p as rule, coalesce(v, 'allow') as verdict
from k left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
qualify row_number() over (partition by page_id order by length(h) desc, length(p) desc) = 1
"""
