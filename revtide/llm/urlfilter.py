"""URL filter: allow and block rules, and gradient-boosted trees where no rule fits.

The trees see lexical features of the URL: lengths, depth, digit ratio, character entropy,
parameter counts, hyphens and labels of the host, and statistics of its suffix (how common it is
and how many of the labelled URLs under it are blocked). The statistics count all labelled URLs;
those of the ``SUFFIXES`` commonest suffixes go to every task, the others are joined. In training a
URL's own label is left out of them. The trees alone are fitted on a bounded sample of the labelled
URLs, those of least hash.

Rules are ``host/path`` with an action. A rule fits its host and all subdomains if the URL's path
starts with the rule's; the longest rule that fits wins, between equals the longer host.

Cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is judged
by the trees. Repeated rows and NULL ids are judged like any other. An empty table gives an empty
result. Without labelled URLs of both kinds there are no trees and the verdict is ``allow``.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import stored

#: Labelled URLs that the trees are fitted on.
SAMPLE = 20_000
#: Suffixes whose statistics go to every task.
SUFFIXES = 4096
TREES, DEPTH, SEED = 20, 3, 7
#: The rules are part of the plan.
MAX_RULES = 1000

#: Characters whose shares make up the entropy.
LETTERS = string.ascii_lowercase + string.digits + "./-_?=&#%+:"

FEATURES = [
    "length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "hyphens",
    "digit_ratio",
    "parameters",
    "parameter_length",
    "entropy",
    "suffix_share",
    "suffix_blocked",
]


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host``, A-Z lower-cased, and ``path``; both empty without ``://``."""
    rest = F.expr("if(instr(url, '://') > 0, substr(url, instr(url, '://') + 3), '')")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return pages.withColumns(
        {
            "host": F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")),
            "path": F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def fitting_rule(rules: dict[str, str]) -> tuple[Column, Column]:
    """The rule that wins for ``host`` and ``path`` and its action, NULL where none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (len(r), len(r.partition("/")[0]), r))
    for text in order:  # later ones win
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(rules[text])).otherwise(action)
    return rule, action


def _lexical(urls: DataFrame) -> DataFrame:
    """The features that a URL has by itself, and its suffix."""
    url = F.lower(F.coalesce("url", F.lit("")))
    length = F.length(url)
    entropy = F.lit(0.0)
    for letter in LETTERS:
        share = (length - F.length(F.replace(url, F.lit(letter), F.lit("")))) / F.greatest(length, F.lit(1))
        entropy = entropy - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    query = F.expr(_query())
    return urls.withColumns(
        {
            "length": length.cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": F.size(F.expr("filter(split(path, '/'), p -> p <> '')")).cast("double"),
            "labels": F.size(F.split("host", r"\.")).cast("double"),
            "hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double"),
            "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(length, F.lit(1)),
            "parameters": F.size(F.expr(f"filter(split({_query()}, '&'), p -> p <> '')")).cast("double"),
            "parameter_length": F.length(query).cast("double"),
            "entropy": entropy,
            "suffix": _suffix(),
        }
    )


def _suffix() -> Column:
    return F.element_at(F.split("host", r"\."), -1)


def _query() -> str:
    return "regexp_extract(coalesce(url, ''), '[?]([^#]*)', 1)"


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def _counted(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``rows`` with ``seen`` and ``bad`` of their ``suffix``, NULL where no labelled URL has it."""
    common = suffixes.filter("common").select("suffix", "seen", "bad")
    rows = rows.join(F.broadcast(common), "suffix", "left")
    rare = suffixes.filter("not common")
    if rare.isEmpty():
        return rows
    # A host holds no slash: rows that have their counts match nothing, and are dealt out evenly.
    done = F.concat("suffix", F.lit("/"), F.pmod(F.xxhash64("url"), F.lit(4096)).cast("string"))
    rare = rare.select(F.col("suffix").alias("_rare"), F.col("seen").alias("_seen"), F.col("bad").alias("_bad"))
    joined = rows.withColumn("_key", F.when(F.col("seen").isNull(), F.col("suffix")).otherwise(done)).join(
        rare.hint("merge"), F.col("_key") == F.col("_rare"), "left"
    )
    return joined.withColumns({"seen": F.coalesce("seen", "_seen"), "bad": F.coalesce("bad", "_bad")}).drop("_key", "_rare", "_seen", "_bad")


class UrlModel:
    """The fitted trees and the suffix statistics."""

    def __init__(self, trees: GBTClassificationModel, suffixes: DataFrame, total: int):
        self.trees, self.suffixes, self.total = trees, suffixes, total

    def judged(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with ``host`` and ``path``) and ``_blocked``, 1.0 where the trees say so."""
        rows = _counted(_lexical(urls), self.suffixes)
        seen, bad = F.coalesce("seen", F.lit(0)), F.coalesce("bad", F.lit(0.0))
        rows = rows.withColumns(
            {"suffix_share": seen / F.lit(float(self.total)), "suffix_blocked": (bad + 0.5) / (seen + 1.0)}
        )
        scored = self.trees.transform(_assembled(rows))
        return scored.select(*urls.columns, F.col("prediction").alias("_blocked"))


def train(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel | None:
    """Fit on at most ``sample`` rows of ``labelled`` (``url``, ``host``, ``path``, ``blocked`` 0 or 1)."""
    chosen = labelled.filter("blocked is not null").select(
        "url", "host", "path", F.col("blocked").cast("double").alias("blocked"), F.xxhash64("url", F.lit(11)).alias("_order")
    )
    rows = stored(_lexical(chosen.orderBy("_order", "url").limit(sample)).coalesce(2))
    kinds = rows.agg(F.count("*").alias("n"), F.sum("blocked").alias("bad")).first()
    if not kinds.n or not 0 < kinds.bad < kinds.n:
        return None
    counts = stored(chosen.groupBy(_suffix().alias("suffix")).agg(F.count("*").alias("seen"), F.sum("blocked").alias("bad")))
    top = counts.orderBy(F.desc("seen"), "suffix").limit(SUFFIXES).select(F.col("suffix").alias("_top"))
    suffixes = stored(
        counts.join(F.broadcast(top), F.col("suffix") == F.col("_top"), "left").select(
            "suffix", "seen", "bad", F.col("_top").isNotNull().alias("common")
        )
    )
    found = suffixes.agg(F.sum("seen").alias("seen")).first()
    others = _counted(rows, suffixes).withColumns(
        {
            "suffix_share": F.col("seen") / F.lit(float(found.seen)),
            "suffix_blocked": (F.col("bad") - F.col("blocked") + 0.5) / F.col("seen"),
        }
    )
    trees = GBTClassifier(
        featuresCol="_features", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32
    )
    return UrlModel(trees.fit(_assembled(others).select("_features", "blocked")), suffixes, found.seen)


def judge(pages: DataFrame, rules: dict[str, str], model: UrlModel | None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``)."""
    urls = with_host_and_path(pages.select("page_id", "url"))
    rule, action = fitting_rule(rules)
    scored = model.judged(urls) if model else urls.withColumn("_blocked", F.lit(0.0))
    own = F.when(F.col("_blocked") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"))


# Host words that mark a labelled URL as one to block.
BLOCKED_WORDS = ("casino", "pills", "bets", "spam", "ads-", "porn", "viagra", "lottery")


def labelled_by_words(pages: DataFrame) -> DataFrame:
    """Labelled URLs from a table of pages: blocked where the host holds one of ``BLOCKED_WORDS``.

    The trees never see these words; they learn how such URLs look.
    """
    urls = with_host_and_path(pages.select("url")).filter("host <> ''")
    words = "|".join(BLOCKED_WORDS)
    return urls.withColumn("blocked", F.col("host").rlike(words).cast("double"))
