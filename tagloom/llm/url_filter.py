"""URL filtering by host and path rules, then by mined association rules."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import materialise, sized

#: Rules that are compiled into an expression; more are joined by host.
INLINE_RULES = 1000
BAD = "label:bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    """``verdict`` (allow or block) for a host, its subdomains and a path prefix."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _precedence(rules: list[UrlRule]) -> list[UrlRule]:
    """Longest first; of equally long ones block, then the first by text."""
    return sorted(rules, key=lambda r: (-len(r.rule), r.verdict != "block", r.rule))


def with_rule(urls: DataFrame, rules: list[UrlRule], inline: int = INLINE_RULES) -> DataFrame:
    """``urls`` (with host and path) plus ``rule`` and ``rule_verdict`` of the longest rule that fits.

    Of equally long ones a block rule wins, then the first by text. Few rules become
    one expression, many a table joined by host; both give the same rows.
    """
    if len(rules) <= inline:
        none = F.lit(None).cast("struct<rule:string,verdict:string>")
        chosen = none
        for r in reversed(_precedence(rules)):
            fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
            chosen = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
        found = urls.withColumn("__rule", chosen)
        return found.select(*urls.columns, F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("rule_verdict"))
    table = urls.sparkSession.createDataFrame([(r.host, r.path, r.rule, r.verdict) for r in rules], "rule_host string, rule_path string, rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes)).join(table, "rule_host").where(F.startswith("path", "rule_path"))
    rank = F.struct(-F.length("rule"), F.col("verdict") != "block", "rule")
    best = pairs.groupBy("host", "path").agg(F.min_by("rule", rank).alias("rule"), F.min_by("verdict", rank).alias("rule_verdict"))
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, "rule", "rule_verdict")


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path segments and query keys; digit runs become 0."""
    tag = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}:"), x))
    plain = lambda text: F.regexp_replace(F.lower(text), r"\d+", "0")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1))
    every = F.concat(
        tag("scheme", F.array(F.regexp_extract(url, r"^([a-zA-Z]+)://", 1))),
        tag("host", F.split(host_of(url), r"\.")),
        tag("path", F.split(plain(path_of(url)), "/")),
        tag("query", keys),
    )
    return F.array_distinct(F.coalesce(every, F.array().cast("array<string>")))


def _classes(tokens: DataFrame, least: float) -> DataFrame:
    """(token, freq, item): tokens in ``least`` rows or more; ``item`` is the first of those in just the same rows."""
    each = tokens.select("row", F.explode("tokens").alias("token"))
    seen = each.groupBy("token").agg(F.count("*").alias("freq"), F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b")).where(F.col("freq") >= least - 1e-6)
    seen = materialise(seen, "url-seen")
    firsts = seen.groupBy("freq", "a", "b").agg(F.min("token").alias("item"))
    return materialise(seen.join(firsts, ["freq", "a", "b"]).select("token", "freq", "item"), "url-classes")


def _minimal(rules: DataFrame) -> DataFrame:
    """Rules without those of which a part is as confident."""
    exploded = rules.withColumn("token", F.explode("antecedent"))
    shorter = exploded.join(rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"), F.col("antecedent")[0].alias("token")), "token")
    implied = (
        shorter.where((F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0) & (F.col("part_confidence") >= F.col("confidence")))
        .select("antecedent")
        .distinct()
    )
    return rules.join(implied, "antecedent", "left_anti")


def _spelled_out(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """(antecedent, confidence, pivot): each rule of items as the rules of one token per item."""
    members = classes.groupBy(F.col("item").alias("token")).agg(F.collect_list("token").alias("members"), F.max("freq").alias("freq"))
    parts = rules.withColumn("token", F.explode("antecedent")).join(members, "token").groupBy("antecedent", "confidence").agg(F.collect_list("members").alias("choices"), F.min_by("members", F.struct("freq", "token")).alias("rarest"))
    one = F.array(F.array().cast("array<string>"))
    every = F.aggregate("choices", one, lambda found, choice: F.flatten(F.transform(found, lambda x: F.transform(choice, lambda t: F.array_append(x, t)))))
    rules = parts.select("confidence", "rarest", F.explode(every).alias("antecedent"))
    return rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", F.array_min(F.array_intersect("antecedent", "rarest")).alias("pivot"))


def mine_rules(labelled: DataFrame, min_support: float = 0.001, min_rows: int = 20, min_lift: float = 1.5, deviations: float = 2.6) -> DataFrame:
    """Token combinations that mark bad URLs: (antecedent, confidence, pivot).

    ``labelled(url, bad)``. FP-growth finds the combinations in at least
    ``min_support`` of the rows and in ``min_rows`` of them. Tokens in just the same rows
    are mined as one item, and its rules are spelled out with each of them: rows that
    repeat a long URL would otherwise have a combination for each subset of its tokens.
    A rule for the bad label stays if its confidence is surely ``min_lift`` times the
    share of bad rows, or half way from that share to 1 if that is less: the lower end of
    the Wilson interval of so many ``deviations`` has to reach that. So the bar follows
    the labels, and a combination of few rows needs a clearer case. A rule goes if one
    with fewer of the same tokens is as confident. The pivot is the rule's rarest token.

    Defined cases: rows with a null url or label are left out; repeated rows count each
    time; fewer than ``min_rows`` rows, or labels of one kind, give no rules.
    """
    tokens = labelled.where("url is not null and bad is not null").select(url_tokens(F.col("url")).alias("tokens"), "bad", F.monotonically_increasing_id().alias("row"))
    tokens = materialise(tokens, "url-tokens")
    rows, share = tokens.agg(F.count("*"), F.avg(F.col("bad").cast("int"))).first()
    empty = "antecedent array<string>, confidence double, pivot string"
    if rows < min_rows:
        return labelled.sparkSession.createDataFrame([], empty)
    bar = min(share * min_lift, (1 + share) / 2)
    support = min(1.0, max(min_support, min_rows / rows))
    classes = _classes(tokens, support * rows)
    items = sized(classes.where("token = item").select("token"))
    held = tokens.select("row", F.explode("tokens").alias("token")).join(items, "token").groupBy("row").agg(F.collect_list("token").alias("tokens"))
    every = tokens.select("row", "bad").join(held, "row", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    baskets = every.select(F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=bar).fit(baskets)
    p, n, z = F.col("confidence"), F.round(F.col("support") / F.col("confidence") * rows), deviations
    surely = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    found = model.associationRules.where((F.col("consequent") == F.array(F.lit(BAD))) & (surely >= bar))
    rules = materialise(found.select(F.array_sort("antecedent").alias("antecedent"), "confidence"), "url-rules")
    return _spelled_out(_minimal(rules), classes)


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that hold all tokens of some rule; rules are found by their pivot."""
    own = urls.where("url is not null").select("url", url_tokens(F.col("url")).alias("tokens"))
    probes = own.withColumn("pivot", F.explode("tokens"))
    met = probes.join(rules.select("pivot", "antecedent"), "pivot").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return met.select("url").distinct()


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[UrlRule], **mining) -> DataFrame:
    """Verdict on every row of ``pages(page_id, url)``.

    Returns page_id, url, host, path, rule (longest host and path rule that fits,
    else null) and verdict: the rule's, else block for URLs with a mined
    combination, else allow.

    Defined cases: a null url, or one without ``://``, has empty host and path,
    fits no rule and, if null, matches no combination; a url of any length is one
    set of tokens; of equally long rules that fit block wins; repeated rows get equal
    verdicts; other columns are ignored; without ``min_rows`` labelled rows no
    rule is mined; an empty table gives an empty result.
    """
    mined = materialise(mine_rules(labelled, **mining), "url-mined")
    blocked = materialise(matching_urls(pages, mined), "url-blocked").withColumn("bad_url", F.lit(True))
    own = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = with_rule(own, rules).join(blocked, "url", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("bad_url"), F.lit("block")), F.lit("allow"))
    return judged.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"))
