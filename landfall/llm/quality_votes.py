"""Quality of documents by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one statistic of the whole text and votes *good*, votes *bad* or abstains. Nobody says how far a
rule can be trusted: expectation-maximisation over the votes estimates how often each is right on good and on
bad documents, and the share of good ones. Documents with the same votes are one row for it, so it works on at most
3^10 rows however many documents there are. The posterior probability of *good* replaces a filter
in which one failed rule decides.

Only Spark SQL functions; no Python sees a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import SPACE, WORD, stage

WINDOW = 3  # words of a repeated window
ROUNDS = 50  # of expectation-maximisation, at most
SETTLED = 1e-7  # change of a parameter below which it ends
_SMOOTH = 1.0  # votes added on either side of every estimate


@dataclass(frozen=True)
class Rule:
    """A statistic with the bounds of a good and of a bad vote; in between, or where it is null, the rule abstains."""

    name: str
    value: str
    good: str
    bad: str

    def vote(self) -> Column:
        value = F.expr(self.value)
        good, bad = (F.expr(bound.replace("x", f"({self.value})")) for bound in (self.good, self.bad))
        return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


RULES = (
    Rule("length", "n_words", "x between 100 and 100000", "x < 50"),
    Rule("word_length", "word_chars / nullif(n_words, 0)", "x between 3.5 and 8", "x < 3 or x > 10"),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", "x <= 0.02", "x > 0.1"),
    Rule("shouting", "n_exclamations / nullif(n_words, 0)", "x <= 0.02", "x > 0.1"),
    Rule("capitals", "n_capitals / nullif(n_letters, 0)", "x <= 0.1", "x > 0.3"),
    Rule("letters", "n_letters / nullif(word_chars, 0)", "x >= 0.93", "x < 0.88"),
    Rule("bare_words", "n_bare_words / nullif(n_words, 0)", "x <= 0.05", "x > 0.2"),
    Rule("sentences", "n_sentences / nullif(n_words, 0)", "x >= 0.05", "x < 0.03"),
    Rule("repeated_lines", "case when n_lines > 1 then n_dup_lines / n_lines end", "x = 0", "x > 0.3"),
    Rule("repeated_words", "case when n_words >= 3 then n_repeat_words / n_words end", "x <= 0.1", "x > 0.3"),
)


# --- statistics ------------------------------------------------------------------------------------


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and counts of every whole text, one row for each row of ``docs``; a null text is empty.

    ``n_bare_words`` counts words without a letter.
    ``n_dup_lines`` counts lines with a word that equal an earlier line, ``n_repeat_words`` the words in windows of
    three words that stand in the text at least twice.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", SPACE, -1), "").alias("words"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace("text", pattern, ""))

    counts = {
        "n_words": F.size("words"),
        "word_chars": F.char_length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("text", F.lit("[#*$%&|<>]")),
        "n_exclamations": F.regexp_count("text", F.lit("[!?]")),
        "n_sentences": F.regexp_count("text", F.lit(r"[.!?…。](?=[\x20\x09-\x0D]|\z)")),
        "n_bare_words": F.regexp_count("text", F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])")),
        "n_capitals": left(r"[^\p{Lu}]+"),
        "n_letters": left(r"[^\p{L}]+"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
    }
    counted = rows.select("doc_id", "words", *[c.cast("long").alias(n) for n, c in counts.items()])
    return _repeated_words(counted).drop("words")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``. Windows are told apart by a hash; only texts in which one occurs twice are looked at closer.

    There the windows are sorted by hash and words with their place, so equal ones are neighbours, and the places
    covered by windows with an equal neighbour are added up.
    """
    words = F.col("words")
    at = lambda i, k: F.get(words, i + k)
    last = F.size(words) - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: [at(i, k) for k in range(WINDOW)]
    rows = rows.withColumn("hashes", F.transform(places, lambda i: F.xxhash64(*window(i))))
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    entry = lambda h, i: F.struct(h.alias("h"), *[w.alias(f"w{k}") for k, w in enumerate(window(i))], i.alias("i"))
    rows = rows.withColumn("windows", F.when(twice, F.sort_array(F.transform("hashes", entry)))).drop("hashes")

    keys = ["h", *[f"w{k}" for k in range(WINDOW)]]

    def same(x, y):
        return F.coalesce(_all([x[k] == y[k] for k in keys]), F.lit(False))

    neighbour = lambda k: F.get(F.col("windows"), k)
    repeated = F.filter("windows", lambda x, k: same(x, neighbour(k - 1)) | same(x, neighbour(k + 1)))
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        starts,
        state,
        lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n")),
        lambda acc: acc["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("windows")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


# --- votes and their weights -----------------------------------------------------------------------


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and how often each rule is right where it votes, on good and on bad ones."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def posterior(self) -> Column:
        """Probability of *good* given the column ``votes``."""
        rates = [F.array(*[F.lit(x) for x in r]).alias(n) for n, r in (("on_good", self.on_good), ("on_bad", self.on_bad))]
        return _posterior(F.struct(F.lit(self.prior).alias("prior"), *rates), F.col("votes"), len(self.on_good))


def _posterior(model: Column, votes: Column, rules: int) -> Column:
    """Naive Bayes over the votes; an abstention says nothing."""
    odds = F.log(model["prior"] / (1 - model["prior"]))
    for j in range(rules):
        vote, a, b = F.get(votes, F.lit(j)), F.get(model["on_good"], F.lit(j)), F.get(model["on_bad"], F.lit(j))
        odds = odds + F.when(vote == 1, F.log(a / (1 - b))).when(vote == -1, F.log((1 - a) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def cast_votes(statistics: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``votes``: 1, -1 or 0 for each rule."""
    return statistics.withColumn("votes", F.array(*[r.vote() for r in rules]))


def fit_votes(voted: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS) -> VoteModel:
    """Estimate the model from the votes alone, over all documents.

    The first guess is the filter that this replaces, at 0.1 where a rule votes bad and 0.9 elsewhere; it settles what
    *good* means and nothing else. Documents are summed by their votes, which gives at most 3^rules sums in one row, and all
    rounds are one expression over that row. Estimates are rounded after each round, so reruns agree. Without documents, or
    with abstentions only, every rule stays at one half.
    """
    sums = voted.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    said = lambda vote: F.transform("votes", lambda v: F.when(v == vote, 1.0).otherwise(0.0))
    sums = sums.select("votes", "n", F.concat(said(1), said(-1)).alias("said"))
    row = sums.agg(F.sort_array(F.collect_list(F.struct("votes", "n", "said"))).alias("patterns"))

    def filtered(x):
        return F.when(F.array_contains(x["votes"], F.lit(-1).cast("tinyint")), 0.1).otherwise(0.9)

    def improve(model):
        return _estimates(lambda x: _posterior(model, x["votes"], len(rules)), len(rules), model)

    start = _estimates(filtered, len(rules), None)
    fitted = F.aggregate(F.sequence(F.lit(2), F.lit(rounds)), start, lambda model, _: F.when(model["settled"], model).otherwise(improve(model)))
    found = row.select(fitted.alias("model")).select("model.*").first()
    return VoteModel(found.prior, tuple(found.on_good), tuple(found.on_bad))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _estimates(good, rules: int, before: Column | None) -> Column:
    """Share of good documents and how often each rule is right, from votes split by the probability of *good*.

    ``said`` of a pattern marks its good votes and then its bad ones, so sums over it are the votes of each rule.
    """
    nothing = F.array_repeat(F.lit(0.0), 2 * rules)
    start = F.struct(nothing.alias("good"), nothing.alias("bad"), F.lit(0.0).alias("goods"), F.lit(0.0).alias("bads"))

    def add(acc, x):
        def split(g):
            def more(k, n):
                return [F.zip_with(acc[k], x["said"], lambda a, s: a + s * n).alias(k), (acc[f"{k}s"] + n).alias(f"{k}s")]

            good_sums, bad_sums = more("good", x["n"] * g), more("bad", x["n"] * (1 - g))
            return F.struct(good_sums[0], bad_sums[0], good_sums[1], bad_sums[1])

        return _let(good(x), split)

    def share(right, wrong):
        return F.round((right + _SMOOTH) / (right + wrong + 2 * _SMOOTH), 12)

    def rates(sums):
        votes = lambda k, first: F.slice(sums[k], first, rules)
        on_good = F.zip_with(votes("good", 1), votes("good", rules + 1), share)
        on_bad = F.zip_with(votes("bad", rules + 1), votes("bad", 1), share)
        return F.struct(share(sums["goods"], sums["bads"]).alias("prior"), on_good.alias("on_good"), on_bad.alias("on_bad"))

    def with_change(m):
        settled = F.lit(False)
        if before is not None:
            far = lambda x, y: F.abs(x - y)
            settled = F.array_max(F.concat(F.array(far(m["prior"], before["prior"])), *[F.zip_with(m[k], before[k], far) for k in ("on_good", "on_bad")])) < SETTLED
        return F.struct(*[m[k].alias(k) for k in ("prior", "on_good", "on_bad")], settled.alias("settled"))

    return _let(F.aggregate("patterns", start, add, rates), with_change)


# --- verdict ---------------------------------------------------------------------------------------

BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def judge_quality(docs: DataFrame, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts of ``text_statistics``, votes, ``quality`` (posterior of *good*), base_failed and kept.

    One row for each row of ``docs``: null and empty texts fail the base rules and go, repeated rows and null ids are
    judged each for itself, other columns are not read. ``kept`` needs the base rules and a quality of at least
    ``threshold``. Texts are read once and nothing but votes is shuffled.
    """
    voted = stage(cast_votes(text_statistics(docs, doc_id, text), rules), "statistics")
    quality = fit_votes(voted, rules).posterior()
    scored = voted.withColumns({"quality": quality, "base_failed": F.expr(BASE_FAILED)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
