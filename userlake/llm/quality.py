"""Quality rules of documents and of the hosts they come from.

Base rules judge a document by itself. A host is judged rule by rule (few words,
repeated windows, symbols, repeated lines) by the share of its documents that
fail: a beta prior is fitted to the counts of all hosts, each host's rate is
shrunk towards it, and the documents of a host with a shrunk rate above a bound
in any rule are rejected too. DataFrame functions only.

Defined cases: a null or blank text has no words and fails; a null source
belongs to no host, so only the base rules judge it; repeated rows count as
often as they occur; an empty table gives an empty result; further columns are
kept, and a figure replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userlake.llm.common import SPACES, stored, unique_names, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
LINE_SPACES = SPACES.replace("\n", "")
# The lowest bits of a window's key hold its place in the text, the others its hash.
PLACE_BITS = 21
PLACE_MASK = (1 << PLACE_BITS) - 1

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# Symbols a word, and repeated lines among the lines with a word, above which the host rules count a failure.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
# The estimate of a prior starts as if so many documents had shown no difference between hosts.
EVEN_DOCUMENTS = 100
# A prior counts for so many documents at most, as where hosts do not differ more than chance lets them.
MAX_STRENGTH = 1e6
RULES = ["few_words", "repeats", "symbols", "dup_lines"]


@dataclass(frozen=True)
class Prior:
    """Beta prior of the rate at which the documents of a host fail a rule."""

    alpha: float
    beta: float


def _hash_of(key: Column) -> Column:
    return key.bitwiseAND(F.lit(~PLACE_MASK))


def _place_of(key: Column) -> Column:
    return key.bitwiseAND(F.lit(PLACE_MASK))


def _window(words: Column, place: Column) -> list[Column]:
    return [words[(place + k).cast("int")] for k in range(3)]


def _starts(words: Column) -> Column:
    return F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))


def _before(items: Column, k: Column) -> Column:
    return items[F.greatest(k - 1, F.lit(0))]


def _with_equal_neighbour(items: Column, same) -> Column:
    """Of sorted items those that equal the one before or after."""
    last = F.size(items) - 1
    return F.filter(
        items,
        lambda x, k: ((k > 0) & same(x, _before(items, k)))
        | ((k < last) & same(x, items[F.least(k + 1, last)])),
    )


def window_keys(words: Column) -> Column:
    """Hash and place of each three-word window, sorted."""
    return F.sort_array(
        F.transform(
            _starts(words),
            lambda _, i: _hash_of(F.xxhash64(*_window(words, i))).bitwiseOR(i.cast("bigint")),
        )
    )


def collisions(words: Column, hits: Column) -> Column:
    """Of sorted keys of equal hash those whose words differ from the ones before."""
    spelled = lambda key: F.array(*_window(words, _place_of(key)))
    return F.filter(
        hits,
        lambda x, k: (k > 0)
        & (_hash_of(x) == _hash_of(_before(hits, k)))
        & (spelled(x) != spelled(_before(hits, k))),
    )


def spelled_windows(words: Column) -> Column:
    """Words and place of each window, sorted: exact at any length, and slower."""
    return F.sort_array(
        F.transform(
            _starts(words),
            lambda _, i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("w"), i.cast("bigint").alias("i")),
        )
    )


def covered_words(places: Column) -> Column:
    """Words in the windows that start at the given ascending places."""
    last = F.size(places) - 1
    width = F.transform(
        places,
        lambda p, k: F.when(k == last, F.lit(3).cast("bigint")).otherwise(
            F.least(F.lit(3).cast("bigint"), places[F.least(k + 1, last)] - p)
        ),
    )
    return F.aggregate(width, F.lit(0).cast("bigint"), lambda total, x: total + x)


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the base figures of each text.

    Repeated windows are found as neighbours among sorted keys. Their words are
    compared: should two windows share a hash, or the text be too long for the
    place bits, the windows are sorted by their words instead.
    """
    names = unique_names(df, "text", "words", "keys", "hits", "spelled", "places")
    col = {name: F.col(free) for name, free in names.items()}
    whole, words, hits = col["text"], col["words"], col["hits"]
    fits = F.size(words) <= PLACE_MASK
    clean = fits & (F.size(collisions(words, hits)) == 0)
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(LINE_SPACES)) != "")
    spelled_places = F.transform(
        _with_equal_neighbour(col["spelled"], lambda x, y: x["w"] == y["w"]), lambda x: x["i"]
    )
    return (
        df.withColumn(names["text"], F.coalesce(F.col(text), F.lit("")))
        .withColumn(names["words"], words_of(whole))
        .withColumn(names["keys"], F.when(fits, window_keys(words)).otherwise(F.array().cast("array<bigint>")))
        .withColumn(names["hits"], _with_equal_neighbour(col["keys"], lambda x, y: _hash_of(x) == _hash_of(y)))
        .withColumn(
            names["spelled"],
            F.when(clean, F.array().cast("array<struct<w:string,i:bigint>>")).otherwise(spelled_windows(words)),
        )
        .withColumn(
            names["places"],
            F.sort_array(
                F.when(F.size(col["spelled"]) == 0, F.transform(hits, _place_of)).otherwise(spelled_places)
            ),
        )
        .select(
            *[F.col(f"`{c}`") for c in df.columns if c not in [*METRICS, "n_lines"]],
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            covered_words(col["places"]).alias("n_repeat_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
        )
    )


def fails_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def rule_failures() -> dict[str, Column]:
    """The rules that hosts are judged by, over the figures of a document."""
    n_words = F.col("n_words")
    return {
        "few_words": n_words < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n_words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n_words,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_counts(figures: DataFrame, host: str) -> DataFrame:
    """Documents of each host, and those that fail each rule."""
    return (
        figures.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n"), *[F.count_if(fails).alias(rule) for rule, fails in rule_failures().items()])
    )


def fit_priors(hosts: DataFrame, rules: Sequence[str] = RULES) -> dict[str, Prior]:
    """A beta prior for each rule, by the moments of beta-binomial counts; one row reaches the driver.

    With n_i documents and x_i failures of k hosts, N and X in all and m = X/N,
    the spread S = sum n_i (x_i/n_i - m)^2 is m(1-m)(k-1) by chance alone. What
    is beyond that, against the m(1-m)(N - sum n_i^2/N - (k-1)) that hosts of
    one rate each would add, is the share of the variance that lies between
    hosts; the prior's strength is one over it, less one. Hosts weigh by their
    documents, those of one document tell nothing of the spread, and
    EVEN_DOCUMENTS keep a few small hosts from telling all. No spread beyond
    chance gives the strongest prior.
    """
    sums = [F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares")]
    for rule in rules:
        failed = F.col(rule)
        sums += [F.sum(failed).alias(f"{rule}_x"), F.sum(failed * failed / F.col("n")).alias(f"{rule}_s")]
    row = hosts.agg(*sums).first()
    priors = {}
    for rule in rules:
        if not row["n"]:
            priors[rule] = Prior(0.5, 0.5)
            continue
        n, x = row["n"], row[f"{rule}_x"]
        mean, chance = x / n, row["k"] - 1
        one = mean * (1 - mean)
        between = row[f"{rule}_s"] - x * x / n - one * chance
        room = one * (n - row["squares"] / n - chance + EVEN_DOCUMENTS)
        strength = room / between - 1 if between > 0 else MAX_STRENGTH
        strength = min(max(strength, 1 / MAX_STRENGTH), MAX_STRENGTH)
        priors[rule] = Prior(mean * strength, (1 - mean) * strength)
    return priors


def fit_prior(hosts: DataFrame, failed: str = "failed") -> Prior:
    """The prior of one rule, whose failures are in the given column."""
    return fit_priors(hosts, [failed])[failed]


def rejected_hosts(hosts: DataFrame, priors: dict[str, Prior], max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Hosts with a shrunk failure rate above the bound in any rule."""
    above = F.lit(False)
    for rule, prior in priors.items():
        above = above | ((F.col(rule) + prior.alpha) / (F.col("n") + prior.alpha + prior.beta) > max_rate)
    return hosts.where(above).select("host")


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, source, the figures, `base_failed` and `kept` of each document."""
    judged = stored(
        with_metrics(documents.select("doc_id", "source", "text")).select(
            "doc_id", "source", *METRICS, "n_lines", fails_base(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed")
        ),
        "quality",
    )
    hosts = host_counts(judged, "source")
    rejected = rejected_hosts(hosts, fit_priors(hosts)).withColumn("host_failed", F.lit(True))
    joined = judged.join(rejected, judged["source"] == rejected["host"], "left").drop("host")
    return joined.select(
        *judged.columns,
        (~F.col("base_failed") & F.col("host_failed").isNull()).alias("kept"),
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their columns. The base rules run twice, so that no text is stored or shuffled."""
    hosts = stored(host_counts(with_metrics(documents.select("source", "text")), "source"), "quality-hosts")
    rejected = rejected_hosts(hosts, fit_priors(hosts))
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    marked = with_metrics(documents.select(whole.alias("row"), "text"))
    # A generator of one row or none: a filter would be pushed below the figures and take them along, again and again.
    passed = F.when(~fails_base(F.col("n_words"), F.col("n_repeat_words")), F.array("row"))
    good = marked.select(F.explode(passed).alias("row"))
    return good.join(rejected, good["row"]["source"] == rejected["host"], "left_anti").select("row.*")
