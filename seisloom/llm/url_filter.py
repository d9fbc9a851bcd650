"""URL filters: an allow and block list, then gradient-boosted trees on lexical
features (operator 2, DataFrame functions and MLlib only).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: then up to ``?``, ``#`` or the end. A rule ``host/path`` fits its host and
all subdomains where the URL's path starts with the rule's; the longest rule that
fits decides, else the trees: length, depth, digit ratio, entropy, parameter
counts, separators, and how often URLs of the host's suffixes are blocked.

Training: labelled URLs, of which ``SAMPLE`` are expected to be drawn by a hash. Where
none are given, URLs of the table are labelled by ``SEED_WORDS`` in their hosts (a word
list, for tables without labels only); the trees see shape and suffixes, never the words.
A drawn URL's suffix statistics leave out the fold of its own host, so that no URL's
label is among what it is trained on. ``held_out_auc`` measures the trees on hosts
that they were not trained on.

Scale: rules stand in the plan as a map from host to paths and are looked up by as many
of the host's last labels as the longest rule has, so that a long host costs no more.
Suffix statistics are of all labelled URLs (partial sums, one
shuffle); only the trees see a sample. Up to ``SAMPLE`` suffixes are broadcast, so
that judging is one pass without a shuffle; more are joined as Spark sees fit.

Cases: null URL or none with ``://``: host and path empty, no rule, judged by the trees
like others; a host that is a rule's word but not a suffix at a dot does not fit;
no labelled URLs, or of one kind only: every URL without a rule is allowed (or blocked,
if all are blocked); repeated rows repeat.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, unused

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SEED_WORDS = ("casino", "pills", "adult", "bets", "spam", "ads", "porn", "viagra", "loan", "torrent")
SAMPLE, TREES, DEPTH, PRIOR, FOLDS = 20_000, 10, 3, 10.0, 4
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens", "dots",
    "host_hyphens", "longest_label", "fragment", "secure", "suffix_rate", "site_rate",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    by_host: dict[str, list[str]] = {}
    for rule in sorted(rules):
        name, _, rest = rule.partition("/")
        by_host.setdefault(name, []).append("/" + rest)
    if not by_host:
        return F.lit(None).cast("string")
    table = F.create_map(*[x for name, paths in by_host.items() for x in (F.lit(name), F.array(*map(F.lit, paths)))])
    most = max(name.count(".") for name in by_host) + 1
    suffixes = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in range(1, most + 1)]))
    fitting = F.flatten(
        F.transform(
            F.filter(suffixes, lambda s: F.array_contains(F.array(*map(F.lit, by_host)), s)),
            lambda s: F.transform(F.filter(table[s], lambda p: path.startswith(p)), lambda p: F.concat(s, p)),
        )
    )
    return _longest(fitting)


def _longest(rules: Column) -> Column:
    return F.aggregate(rules, F.lit(None).cast("string"), lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best))


def lexical_features(rows: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``rows`` with a struct column ``lexical``, and the suffixes ``suffix`` and ``site``."""
    u, h, p = F.coalesce(F.col(url), F.lit("")), F.col(host), F.col(path)
    n = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    letters = F.array_sort(F.filter(F.split(h, ""), lambda c: c != ""))
    start = F.struct(F.lit("").alias("letter"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    weighed = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(0.0)
    runs = F.aggregate(  # of equal letters, in one pass over the sorted host
        letters, start,
        lambda s, c: F.struct(
            c.alias("letter"), F.when(s["letter"] == c, s["run"] + 1).otherwise(1).alias("run"),
            (s["sum"] + F.when(s["letter"] == c, 0.0).otherwise(weighed(s["run"]))).alias("sum"),
        ),
    )
    entropy = F.when(h != "", F.log2(F.size(letters)) - (runs["sum"] + weighed(runs["run"])) / F.size(letters)).otherwise(0.0)

    def number(text: Column, what: str) -> Column:
        return F.regexp_count(text, F.lit(what)).cast("double")

    labels = F.size(F.split(h, r"\.", -1))
    values = {
        "url_length": n, "host_length": F.length(h), "path_length": F.length(p), "depth": number(p, "/"), "labels": labels,
        "digit_ratio": number(u, "[0-9]") / F.greatest(n, F.lit(1)), "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(number(query, "&") + 1), "hyphens": number(u, "-"), "dots": number(u, r"\."),
        "host_hyphens": number(h, "-"), "longest_label": F.array_max(F.transform(F.split(h, r"\.", -1), F.length)),
        "fragment": u.contains("#").cast("double"), "secure": u.startswith("https").cast("double"),
    }
    lexical = F.struct(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items()])
    return rows.withColumns({"lexical": lexical} | suffixes(h))


def suffixes(host: Column) -> dict[str, Column]:
    """The host's last label, and its last two."""
    labels = F.split(host, r"\.", -1)
    return {"suffix": F.element_at(labels, -1), "site": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")}


def seed_labels(pages: DataFrame, url: str = "url", words=SEED_WORDS) -> DataFrame:
    """``(url, label)``: 1 if a word of the host is a seed word."""
    named = F.filter(F.split(url_host(F.col(url)), "[^a-z]+"), lambda w: w.isin(*words))
    return pages.where(F.col(url).contains("://")).select(F.col(url).alias("url"), F.when(F.size(named) > 0, 1).otherwise(0).alias("label"))


def _hinted(side: DataFrame, most: int = SAMPLE) -> DataFrame:
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


class UrlModel:
    """Trees and suffix statistics, or a constant verdict where labels are of one kind."""

    def __init__(self, trees, suffixes: DataFrame | None, sites: DataFrame | None, base: float):
        self.trees, self.suffixes, self.sites, self.base = trees, suffixes, sites, base
        self.sides = [(by, _hinted(side)) for by, side in (("suffix", suffixes), ("site", sites)) if side is not None]

    def vectors(self, rows: DataFrame) -> DataFrame:
        for by, side in self.sides:
            rows = rows.join(side, by, "left")
        return self.assemble(rows)

    def assemble(self, rows: DataFrame) -> DataFrame:
        """``features`` of rows that have ``suffix_rate`` and ``site_rate``, null for what has no statistics."""
        flat = rows.withColumns(
            {f"f_{x}": F.col(f"lexical.{x}") for x in FEATURES[:-2]}
            | {"f_suffix_rate": F.coalesce("suffix_rate", F.lit(self.base)), "f_site_rate": F.coalesce("site_rate", F.lit(self.base))}
        )
        return VectorAssembler(inputCols=[f"f_{x}" for x in FEATURES], outputCol="features").transform(flat)


def train(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """From ``labelled(url, label)``: 1 block, 0 allow; nulls are left out."""
    rows = labelled.where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label"))
    host = url_host(F.col("url"))
    rows = rows.withColumns({"host": host, "fold": F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")})
    counts = [F.sum("label").alias("blocked"), F.count("*").alias("n")]
    by_site = cut(rows.withColumns(suffixes(F.col("host"))).groupBy("suffix", "site", "fold").agg(*counts))
    blocked, n = by_site.agg(F.coalesce(F.sum("blocked"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    base = blocked / n if n else 0.0
    if base in (0.0, 1.0):
        return UrlModel(None, None, None, base)

    def rate(by: str, blocked: Column, n: Column) -> Column:
        return ((blocked + PRIOR * base) / (n + PRIOR)).alias(f"{by}_rate")

    def rates(by: str) -> DataFrame:
        return cut(by_site.groupBy(by).agg(rate(by, F.sum("blocked"), F.sum("n"))))

    def without_fold(by: str) -> DataFrame:
        """Of each fold, the rates over the others."""
        own = by_site.groupBy(by, "fold").agg(F.sum("blocked").alias("own_blocked"), F.sum("n").alias("own_n"))
        every = by_site.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("blocked", "n")])
        return cut(own.join(every, by).select(by, "fold", rate(by, F.col("blocked") - F.col("own_blocked"), F.col("n") - F.col("own_n"))))

    model = UrlModel(None, rates("suffix"), rates("site"), base)
    draw = F.pmod(F.xxhash64("url", F.lit("urls")), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / n) * (1 << 30)))
    drawn = lexical_features(rows.where(draw).withColumn("path", url_path(F.col("url"))), "url", "host", "path")
    for by in ("suffix", "site"):
        drawn = drawn.join(without_fold(by), [by, "fold"], "left")
    fit = cut(model.assemble(drawn).select("label", "features"))
    if fit.isEmpty():  # few different URLs, none drawn
        return UrlModel(None, None, None, float(base >= 0.5))
    classifier = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=7, cacheNodeIds=False, checkpointInterval=-1)
    model.trees = classifier.fit(fit)
    return model


def held_out_auc(labelled: DataFrame, folds: int = FOLDS, **options) -> float:
    """Area under the ROC curve on the hosts of one fold in ``folds``, of trees and
    statistics from the others; 0.5 where these have one kind of label only."""
    out = F.pmod(F.xxhash64(url_host(F.col("url")), F.lit("held out")), F.lit(folds)) == 0
    model = train(labelled.where(~out), **options)
    if model.trees is None:
        return 0.5
    rows = labelled.where(out).where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    judged = model.trees.transform(model.vectors(lexical_features(rows, "url", "host", "path")))
    return BinaryClassificationEvaluator(labelCol="label").evaluate(judged)


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] | None = None, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of those names are replaced."""
    rules = RULES if rules is None else rules
    model = train(seed_labels(pages, url) if labelled is None else labelled)
    new = ("host", "path", "rule", "verdict")
    held, kept = unused(pages, "row_"), [c for c in pages.columns if c.lower() not in new]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(held), F.col(url).alias("url"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    if model.trees is None:
        method = F.lit("block" if model.base == 1.0 else "allow")
    else:
        rows = model.trees.transform(model.vectors(lexical_features(rows, "url", "host", "path")))
        method = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    ruled = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[F.col("rule")] if rules else F.lit(None)
    verdict = F.coalesce(ruled, method)
    return rows.select(*[F.col(f"{held}.`{c}`").alias(c) for c in kept], "host", "path", "rule", verdict.alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "url")


#: DuckDB SQL for the columns that rules decide: every page, with a null verdict where the trees judge.
RULES_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
t AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM h),
r(rule, domain, prefix, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
f AS (SELECT t.page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM t JOIN r
  ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix) GROUP BY ALL)
SELECT page_id, host, path, rule, verdict FROM t LEFT JOIN f USING (page_id)
"""
