"""Weak supervision, source divergence and fill-in-the-middle against plain Python, and on odd tables."""

import collections
import hashlib
import math
import re

import pytest
import regex
from pyspark.sql import functions as F
from test_llm import SF, WORD, frame, odd_rows

from landfall.llm import divergence, middle, quality_votes
from landfall.llm.queries import QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SPECIAL = [
    (20, "a <P> b", "en", "a"), (21, "a<S>", "en", "a"), (22, "<M>", "fr", "b"), (23, "  lead and trail \n\n", "en", "a"), (24, "x", "en", "d"),
    (25, "<S <M <P>", "en", "a"), (26, "a\tb\x0bc\x0cd\re", "de", "e"), (27, "É𝒳 ñ's Zo-Zo ZO", "de", "e"), (28, "zo zo", "de", "f"), (29, "Zo\x00zo [zo]", "de", None),
    (30, "\n".join(["same line here"] * 9 + ["other words in it now", "", " ", "same line here "]), "en", "g"),
    (31, " ".join(["x y z"] * 40), "en", "g"), (32, "a a a a b c a a b", "en", "g"), (33, "### $$$ %%% " * 30, "en", "h"), (34, "x" * 70_000, "en", "h"),
    (35, "SHOUT!! " * 80, "en", "h"), (36, "a | b | c " * 30, "en", "h"), (-3, "minus and 12 34", "fr", "b"),
]


@pytest.fixture(scope="module")
def rows():
    return odd_rows() + SPECIAL * 2


@pytest.fixture(scope="module")
def odd(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def multiset(found):
    return collections.Counter(map(tuple, found))


# --- 13 fill in the middle -------------------------------------------------------------------------


def fim(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle_part, suffix = ("".join(p) for p in (units[:low], units[low:high], units[high:]))
    spm = h4 % 100 < spm_rate
    output = f"<S>{suffix}<P>{prefix}<M>{middle_part}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle_part}"
    return doc_id, n, "spm" if spm else "psm", len(prefix), len(middle_part), output


@pytest.mark.parametrize(("seed", "rate", "spm_rate"), [(42, 50, 80), (7, 100, 50), (1, 0, 0), (3, 100, 100)])
def test_middle_against_plain_python(odd, rows, seed, rate, spm_rate):
    got = middle.fill_in_middle(odd, seed, rate, spm_rate)
    assert multiset(got.collect()) == multiset(fim(i, t, seed, rate, spm_rate) for i, t, _, _ in rows)
    back = middle.restore(got).select("doc_id", "restored").collect()
    assert multiset(back) == multiset((i, t or "") for i, t, _, _ in rows)


def test_middle_cuts_everywhere(spark):
    texts = [(i, " ".join("wörd" for _ in range(i % 7)), "en", "a") for i in range(400)]
    got = middle.fill_in_middle(frame(spark, texts), rate=100).collect()
    assert multiset(got) == multiset(fim(i, t, rate=100) for i, t, _, _ in texts)
    assert {r.form for r in got} == {"plain", "psm", "spm"} and {r.prefix_chars for r in got} > {0, 4, 9, 14}


def test_middle_slices_and_other_sentinels(odd, rows, monkeypatch):
    from landfall.llm import common

    monkeypatch.setattr(common, "SLICE_BYTES", 100)
    got = middle.restore(middle.fill_in_middle(odd, sentinels=("[[pre", "(suf)", "mid|")), ("[[pre", "(suf)", "mid|"))
    assert multiset(got.select("doc_id", "restored").collect()) == multiset((i, t or "") for i, t, _, _ in rows)


def test_middle_of_nothing(none):
    assert middle.digests(none).count() == 0


# --- 12 source divergence --------------------------------------------------------------------------


def audit(rows, least, top):
    """The contract word by word, over every term of every pair."""
    docs = [(g or "", s or "", [w.lower() for w in TERM.findall((t or "").encode())]) for _, t, g, s in rows]
    out = []
    for lang in {g for g, _, _ in docs}:
        mine = [(s, w) for g, s, w in docs if g == lang]
        spread = collections.Counter(w for _, words in mine for w in set(words))
        kept = sorted(w for w, n in spread.items() if n >= least)
        groups = {s: collections.Counter() for s, _ in mine}
        for s, words in mine:
            groups[s].update(w for w in words if spread[w] >= least)
        total = sum(groups.values(), collections.Counter())

        def share(counts, w, kept=kept):
            return 1 + 10**9 * (counts[w] + 1) // (sum(counts.values()) + len(kept))

        excess = lambda p, q: (p - q) * (p - q) // q
        for s in groups:
            pairs = [(o, sum(excess(share(groups[s], w), share(groups[o], w)) for w in kept)) for o in groups if o != s]
            words = [(w.decode(), excess(share(groups[s], w), share(total, w))) for w in kept if groups[s][w] and share(groups[s], w) > share(total, w)]
            for part, found, limit in (("pair", pairs, None), ("term", words, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return out


@pytest.mark.parametrize(("least", "top"), [(3, 200), (1, 5), (1000, 200)])
def test_divergence_against_plain_python(odd, rows, least, top):
    got = divergence.audit_sources(odd, least, top).select("lang", "source", "part", "item", "value", "rank").collect()
    assert multiset(got) == multiset(audit(rows, least, top)) and len(got) > 0


def test_divergence_counts_handed_on_in_parts(spark, monkeypatch):
    ordinary = [(i, f"the word number{i % 5} the", "en", f"s{i % 3}") for i in range(60)]
    monkeypatch.setattr(divergence, "_HELD", 3)
    rows = ordinary + [(100, "nothing 12 34", "en", "silent")]
    got = divergence.audit_sources(frame(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert multiset(got) == multiset(audit(rows, 3, 200))
    assert {r.item for r in got if r.source == "silent"} == {"s0", "s1", "s2"}


def test_divergence_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 0, 1), (1, 3, 7), (10**12, 10**13, 10**7), (9 * 10**14, 9 * 10**14, 10**9), (5, 8 * 10**15, 12345)]
    frame_ = spark.createDataFrame(cases, "n long, words long, vocabulary long")
    got = [r[0] for r in frame_.select(divergence.share(F.col("n"), "words")).collect()]
    assert got == [1 + 10**9 * (n + 1) // (w + v) for n, w, v in cases]


def test_divergence_of_nothing(none):
    assert divergence.audit_sources(none).count() == 0


# --- 11 quality votes ------------------------------------------------------------------------------


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_exclamations": sum(c in "!?" for c in text),
        "n_bare_words": sum(not regex.search(r"\p{L}", w) for w in words),
        "n_capitals": len(regex.findall(r"\p{Lu}", text)),
        "n_letters": len(regex.findall(r"\p{L}", text)),
        "n_sentences": len(re.findall(r"[.!?…。](?=[\x20\x09-\x0D]|\Z)", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_statistics_against_plain_python(odd, rows, spark):
    names = list(statistics(""))
    got = quality_votes.text_statistics(odd)
    assert multiset(got.select("doc_id", *names).collect()) == multiset((i, *statistics(t).values()) for i, t, _, _ in rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in quality_votes.text_statistics(docs).collect()}
    for r in docs.collect():
        assert {n: found[r.doc_id][n] for n in names} == statistics(r.text)


def em(votes):
    """Expectation-maximisation over documents one by one."""
    rules = len(votes[0])
    good = [0.1 if -1 in v else 0.9 for v in votes]
    model = None
    for _ in range(quality_votes.ROUNDS):
        def share(pick, vote, weight):
            right = sum(weight(g) for g, v in zip(good, votes, strict=True) if pick(v) == vote)
            wrong = sum(weight(g) for g, v in zip(good, votes, strict=True) if pick(v) == -vote)
            return (right + 1) / (right + wrong + 2)

        new = [(sum(good) + 1) / (len(good) + 2)]
        for j in range(rules):
            new += [share(lambda v: v[j], 1, lambda g: g), share(lambda v: v[j], -1, lambda g: 1 - g)]
        done = model and max(abs(a - b) for a, b in zip(new, model, strict=True)) < quality_votes.SETTLED
        model, scores = new, []
        for v in votes:
            odds = math.log(new[0] / (1 - new[0]))
            for j, x in enumerate(v):
                a, b = new[1 + 2 * j : 3 + 2 * j]
                odds += math.log(a / (1 - b)) if x == 1 else math.log((1 - a) / b) if x == -1 else 0
            scores.append(1 / (1 + math.exp(-odds)))
        if done:
            break
        good = scores
    return scores


def test_votes_weighed_like_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = quality_votes.judge_quality(docs).collect()
    expected = em([list(r.votes) for r in judged])
    assert all(abs(r.quality - e) < 1e-6 for r, e in zip(judged, expected, strict=True))
    for r in judged:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.quality >= 0.5)


def test_votes_find_what_people_call_bad(spark):
    """Labels are never shown to the model; they only measure it."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "label")
    got = QUERIES["op11_weak_supervision_quality"](spark, sf).join(labels, "doc_id").where("n_words >= 50").collect()
    bad, good = ([r for r in got if r.label == x] for x in (0, 1))
    assert sum(not r.kept for r in bad) / len(bad) > 0.9
    assert sum(r.kept for r in good) / len(good) > 0.97


def test_abstaining_rules_change_nothing(spark):
    rule = quality_votes.Rule("never", "cast(null as double)", "x > 0", "x < 0")
    docs = frame(spark, [(i, "some ordinary words here. " * (30 if i % 3 else 1), "en", "a") for i in range(30)])
    plain = {r.doc_id: r.quality for r in quality_votes.judge_quality(docs).collect()}
    more = {r.doc_id: r.quality for r in quality_votes.judge_quality(docs, rules=(*quality_votes.RULES, rule)).collect()}
    assert plain == more


def test_quality_of_odd_tables(odd, none, rows):
    got = quality_votes.judge_quality(odd).collect()
    assert len(got) == len(rows) and all(0 <= r.quality <= 1 for r in got)
    assert not any(r.kept for r in got if r.n_words == 0)
    assert quality_votes.judge_quality(none).count() == 0


def test_quality_has_no_python_worker(odd):
    plan = quality_votes.judge_quality(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 10 toxicity on real documents -----------------------------------------------------------------


def test_toxicity_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").where("toxic is not null")
    got = QUERIES["op10_kneser_ney_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    ordered = sorted(got, key=lambda r: r.score)
    places = collections.defaultdict(list)
    for i, r in enumerate(ordered, 1):
        places[r.score].append(i)
    rank = {s: sum(p) / len(p) for s, p in places.items()}
    toxic = [rank[r.score] for r in got if r.toxic]
    area = (sum(toxic) - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * (len(got) - len(toxic)))
    assert len(toxic) > 50 and area >= 0.9, area


def test_peaks_against_every_window():
    import numpy as np

    from landfall.llm import toxicity

    values, counts = np.array([1.0, -2, 3, 4, 5, 0.5, -1, -1]), np.array([5, 0, 1, 2])
    for width in (1, 2, 4):
        at, want = 0, []
        for n in counts:
            own = list(values[at : at + n]) + [0.0] * max(0, width - n)
            want.append(max(sum(own[i : i + width]) / width for i in range(len(own) - width + 1)))
            at += n
        assert np.allclose(toxicity._peaks(values, counts, width), want)


# --- odd rows of earlier operators -----------------------------------------------------------------


def test_one_of_fully_repeated_rows_stays(spark):
    from check import compare, connect

    from landfall.llm import block_naming
    from landfall.llm.queries import EXACT_SQL

    rows = [(1, "a b", "en", "x"), (1, "a b", "en", "x"), (1, "a  b", "en", "x"), (2, "ab", "en", "x"), (3, "c", "en", "x"), (3, "c", "en", "x"), (4, None, "en", "x")]
    df = frame(spark, rows)
    got = block_naming.exact_groups(df)
    con = connect(SF)
    con.register("given", df.select("doc_id", "text").toPandas())
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT doc_id, text FROM given")
    assert compare(got.toPandas(), con.execute(EXACT_SQL).df()) is None
    assert sum(r.kept for r in got.collect()) == 3
    assert {r.doc_id for r in block_naming.drop_exact(df).collect()} == {1, 3, 4}


def test_very_long_digit_runs_are_no_addresses():
    from landfall.llm import pii

    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [(0, 5007, "ip")]
    assert not pii.base_spans("9" * 5000 + ".2.3.4")
