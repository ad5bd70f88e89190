"""The text operators and the pipeline against brute force, and on nulls, empty and long texts, ties, repeats and odd tables."""

import collections
import hashlib
import itertools
import json
import math
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import corpus_pipeline  # noqa: E402
from check import compare, connect  # noqa: E402

from landfall.llm import block_naming, fingerprint, langid, mixing, ngram_join, packing, pii, repeats, tokens, toxicity, wavelet  # noqa: E402
from landfall.llm.common import ship, stage  # noqa: E402
from landfall.llm.components import components  # noqa: E402
from landfall.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "part int, guest int, grp string, m int, seed string, gram string, bucket string, rep string, size string, copies string, edited string, kind string"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def frame(spark, rows):
    """Documents with the given (doc_id, text, lang, source), and columns whose names the operators use inside."""
    ship(spark)
    df = spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], DDL).repartition(2)
    return df.withColumns({c.split()[0]: F.lit(7).cast(c.split()[1]) for c in CLASH.split(", ")})


def odd_rows():
    random.seed(5)
    words = ["".join(random.choices("abcdefgh", k=random.randint(2, 6))) for _ in range(400)]
    long = " ".join(random.choices(words, k=30_000))
    some = " ".join(random.choices(words, k=300))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (4, "...", "de", "b"), (5, "one two", "en", "a"), (6, long, "en", "a")]
    rows += [(7, some, "en", "b"), (7, some, "en", "b"), (8, some, "en", "c"), (9, some + " more", None, "c"), (None, some, "en", "a"), (None, None, "en", None)]
    rows += [(10, long, "de", "c"), (11, "日本語のテキスト é\x00 x", "fr", "b"), (12, "a\x1cb\x85c", "fr", "b")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def shingle_set(text, width=5):
    w = WORD.findall(text or "")
    return set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else ({tuple(w)} if w else set())


# --- registered queries ----------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_counterparts(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, connect(SF).execute(ORACLES[name]).df()) is None


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


# --- 1 language id ---------------------------------------------------------------------------------


def test_langid_held_out_accuracy(spark, docs):
    got = QUERIES["op1_rank_order_langid"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_langid_distance_is_the_out_of_place_sum():
    profiles = {"x": {g: i for i, g in enumerate(sorted(langid.gram_counts("aab ab abc")[0].tolist()))}, "y": {langid.gram_counts("z")[0].tolist()[0]: 0}}
    model, text = langid.Identifier(profiles), "ab ab c"
    grams = collections.Counter(g for w in text.split() for k in (1, 2, 3) for g in (f" {w} "[i : i + k] for i in range(len(w) + 3 - k)) if g != " ")
    assert {langid.gram_text(g): n for g, n in zip(*map(list, langid.gram_counts(text)), strict=True)} == grams
    ordered = sorted(grams.values(), reverse=True)
    for j, profile in enumerate(profiles.values()):
        ranks, total = {langid.gram_text(g): r for g, r in profile.items()}, 0.0
        for g, n in grams.items():
            place = min((ordered.index(n) + len(ordered) - 1 - ordered[::-1].index(n)) / 2, model.places - 1)
            total += abs(ranks[g] - place) if g in ranks else model.places
        assert math.isclose(model.distances(text)[j], total / len(grams) / model.places)


def test_langid_odd_tables(spark, odd, none):
    profiles = langid.train_profiles(odd)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(odd, profiles).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (None, "und")} <= got and (11, "fr") in got
    assert langid.train_profiles(none) == {} and langid.identify(none, profiles).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == 10
    assert langid.keep_identified(none).count() == 0


# --- 2 packing -------------------------------------------------------------------------------------


def check_pieces(rows, ids_of, limits=packing.Limits()):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc, pieces in by_doc.items():
        ids, at = ids_of[doc], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def library_ids(text):
    return tokens.encoder().tokenizer.encode(text or "", add_special_tokens=False).ids + [tokens.END]


def test_packing_holds_every_id_once(spark, docs, texts):
    rows = QUERIES["op2_vector_packing"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert check_pieces(rows, {i: library_ids(t) for i, t in texts.items()}) == 0


def test_packing_odd_tables(spark, odd, none):
    rows = packing.pack_documents(odd.filter("doc_id is not null and doc_id != 7")).collect()
    check_pieces(rows, {i: library_ids(t) for i, t, _, _ in odd_rows()})
    every = packing.pack_documents(odd).agg(F.sum("length")).first()[0]
    assert every == sum(len(library_ids(t)) for _, t, _, _ in odd_rows())
    assert packing.pack_documents(none).count() == 0


def test_packing_keeps_all_limits_and_examples_whole():
    random.seed(2)
    examples = [(i, n := random.randint(1, 900), random.randint(0, n)) for i in range(3000)]
    limits = packing.Limits(tokens=1000, segments=4, loss=600)
    packer = packing.Packer(limits, cut=False, window=64)
    sequences = [*packer.add(examples[:1500]), *packer.add(examples[1500:]), *packer.finish(), packer.open]
    loss, pieces = {i: m for i, _, m in examples}, [p for s in sequences for p in s]
    whole = [p for p in pieces if p[2] == examples[p[0]][1]]
    assert sum(p[2] for p in pieces) == sum(n for _, n, _ in examples)
    assert all(examples[p[0]][1] > 600 for p in pieces if p not in whole)  # only those beyond a limit are cut
    for s in sequences:
        assert sum(p[2] for p in s) <= 1000 and len(s) <= 4
        assert sum(min(loss[p[0]], p[2]) for p in s if p in whole) <= 600


def test_packing_prefers_the_scarce_resource():
    # tokens are plentiful, loss is scarce: the heuristic pairs much loss with little
    examples = [(0, 10, 9), (1, 10, 9), (2, 10, 1), (3, 10, 1)]
    packer = packing.Packer(packing.Limits(tokens=100, segments=2, loss=10), cut=False)
    sequences = [*packer.add(examples), *packer.finish()]
    assert sorted(sorted(p[0] % 4 // 2 for p in s) for s in sequences) == [[0, 1], [0, 1]]


def test_pack_examples(spark):
    ship(spark)
    df = spark.createDataFrame([("a", 900, 100), ("b", 200, None), ("c", None, 3), ("d", 5000, 10)], "key string, n long, loss long")
    rows = packing.pack_examples(df, "key", "n", "loss").collect()
    sums = collections.Counter()
    for r in rows:
        sums[r.key] += r.length
    assert sums == {"a": 900, "b": 200, "d": 5000}


# --- 3 fingerprints --------------------------------------------------------------------------------


def test_fingerprints(spark, docs, texts):
    rows = {r.doc_id: r for r in QUERIES["op3_one_permutation_minhash"](spark, SF).collect()}
    order = sorted(texts, reverse=True)
    like, prints = [], collections.defaultdict(set)
    for k, i in enumerate(order):
        text, after, r = texts[i], texts[order[(k + 1) % len(order)]], rows[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingle_set(text), shingle_set(edited)
        like.append(abs(r.near_edited - len(a & b) / max(1, len(a | b))))
        prints[text].add(r.fingerprint)
    assert sum(like) / len(like) < 0.04 and all(len(p) == 1 for p in prints.values())


def test_fingerprints_over_several_ranges(spark, docs, texts, monkeypatch):
    one = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    monkeypatch.setattr(fingerprint, "RANGE_DOCS", 13)
    assert {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()} == one


def test_fingerprints_densify_like_the_definition(spark):
    text = "a b c d e f g h"
    got = fingerprint.with_fingerprint(spark.createDataFrame([(text,), ("x",)], "text string"), "text", "f").collect()
    full = {r.text: r.f for r in got}
    assert len(full[text]) == 256 and len(set(full[text])) <= 4 and len(set(full["x"])) == 1


def test_fingerprints_odd_tables(spark, odd, none):
    rows = fingerprint.fingerprints(odd).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(rows) == len(odd_rows()) and by[1][0].fingerprint == by[2][0].fingerprint == by[3][0].fingerprint == ""
    assert by[7][0].fingerprint == by[8][0].fingerprint != by[9][0].fingerprint
    assert {r.near_next for r in by[8]} == {1.0} and all(0 <= r.near_edited <= 1 for r in rows)
    assert fingerprint.fingerprints(none).count() == 0


# --- 4 personal data -------------------------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
            ok = ok or kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_base_spans_match_the_plain_patterns():
    random.seed(1)
    for _ in range(20_000):
        text = "".join(random.choices("ab1234567890.@+-() %_\n4111111111111111é", k=random.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1 " * 100_000, "a@" * 100_000):
        pii.base_spans(text), pii.candidates(text, [])


def test_bootstrapping_discovers_unseen_identifiers(spark):
    rows = [(i, f"Blah {i} text. Please call my phone number +1 (555) 01{i:02d}-4567 today", "en", "a") for i in range(20)]
    rows += [(50, "again: Call my phone number 0555-77-8899 today", "en", "a"), (51, "order number 0555-77-1234 was sent", "en", "a"), (52, "token = 99887766aabb", "en", "a")]
    got = {r.doc_id: r for r in pii.find_personal_data(frame(spark, rows)).collect()}
    text = rows[20][1]
    start = text.index("0555")
    assert got[50].found == f"phone:{start}:{start + 12}" == got[50].spans and got[50].n_phone == 0 and got[50].n_found == 1
    assert got[51].found == "" and got[52].found == "" and got[3].n_phone == 1 and got[3].found == ""


def test_bootstrap_scores_match_a_loop(spark):
    ship(spark)
    random.seed(3)
    links = [(random.choice(["email", None, None]), f"i{random.randint(0, 12)}", f"p{random.randint(0, 3)}") for _ in range(60)]
    trusted, known = pii.bootstrap(spark.createDataFrame(links, "kind string, instance string, pattern string"), rounds=2, trust=0.3, support=2)
    edges, seeds = {(p, i) for _, i, p in links}, {i for k, i, _ in links if k}
    score = dict.fromkeys(seeds, 1.0)
    for _ in range(2):
        good = {}
        for p in {p for p, _ in edges}:
            own = [i for q, i in edges if q == p]
            mass = sum(score.get(i, 0) for i in own)
            if mass >= 2 and mass / len(own) >= 0.3:
                good[p] = mass / len(own)
        score = dict.fromkeys(seeds, 1.0)
        for i in {i for _, i in edges} - seeds:
            reach = [min(good[p], 0.999) for p, j in edges if j == i and p in good]
            if reach:
                score[i] = 1 - math.prod(1 - s for s in reach)
    assert {r.pattern: round(r.score, 6) for r in trusted.collect()} == {p: round(s, 6) for p, s in good.items()}
    assert {r.instance: round(r.score, 6) for r in known.collect()} == {i: round(s, 6) for i, s in score.items()}


def test_pii_query_and_odd_tables(spark, docs, texts, odd, none):
    for r in QUERIES["op4_bootstrapped_pii"](spark, SF).collect():
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, _, k in base) for kind in PLAIN]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(odd_rows()) and {r.spans for r in rows} == {""}
    assert pii.find_personal_data(none).count() == 0


# --- 5 wavelet shards ------------------------------------------------------------------------------


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 3), (1000, 5), (5000, 49_408), (1537, 70_000)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    w = wavelet.WaveletMatrix.build(ids)
    w = wavelet.WaveletMatrix(w.n, w.zeros, [p.tobytes() for p in w.planes], [r.tobytes() for r in w.ranks])
    assert (w.decode() == ids).all() and w.count(top + 5) == 0
    for i in range(0, n, max(1, n // 50)):
        assert w.access(i) == ids[i] and w.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
    for token in set(ids[:20].tolist()):
        places = np.flatnonzero(ids == token)
        assert w.count(token) == len(places) and [w.select(token, k) for k in range(len(places))] == places.tolist()
    with pytest.raises(IndexError):
        w.access(n)


def test_encoder_matches_the_library():
    random.seed(3)
    pool = "aAbBzZ019'’sStTrevdlm .,-!?_<|>\n\t\r\x0b\x0c\x1c\x85\xa0éÉßñöÿŸİıŉĲĳſΣςΩ中日́̈²½ªµ٣😀 ﻿"
    many = ["".join(random.choices(pool, k=random.randint(0, 40))) for _ in range(5000)] + ["<|endoftext|>", "a<|startoftext|>b", "'S'T'Re", "don't I'LL", None, ""]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder().encode(many)]
    assert got == [library_ids(t)[:-1] for t in many]


def test_wavelet_shards_round_trip(spark, docs, texts, tmp_path):
    got = {r.doc_id: r for r in QUERIES["op5_wavelet_shards"](spark, SF).collect()}
    at = 0
    for i in sorted(texts):
        ids = library_ids(texts[i])
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    path = f"file://{tmp_path}/shards"
    wavelet.write_shards(docs, path, shard_tokens=5000)
    files = [f for f in (tmp_path / "shards").glob("*.parquet")]
    shards = spark.read.parquet(path)
    assert len(files) == shards.count() > 5 and shards.agg(F.sum("n_tokens")).first()[0] == at
    assert {r.doc_id: r.start for r in wavelet.read_documents(spark, path).collect()} == {i: r.start for i, r in got.items()}
    the = library_ids("the")[0]
    assert wavelet.occurrences(spark, path, the).agg(F.sum("n")).first()[0] == sum(library_ids(t).count(the) for t in texts.values())


def test_wavelet_odd_tables(spark, odd, none):
    rows = wavelet.round_trip(odd, shard_tokens=1000).collect()
    assert len(rows) == len(odd_rows()) and sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    assert rows and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert wavelet.round_trip(none).count() == 0


# --- 6 repeated passages ---------------------------------------------------------------------------


def test_repeats_against_every_window(spark, docs, texts):
    words = {i: WORD.findall(t) for i, t in texts.items()}
    holders = collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    want = {i: {p for k in range(len(w) - 49) if len(holders[tuple(w[k : k + 50])]) > 1 for p in range(k, k + 50)} for i, w in words.items()}
    got = collections.defaultdict(set)
    for r in QUERIES["op6_sparse_suffix_repeats"](spark, SF).collect():
        got[r.doc_id].update(range(r.start, r.end))
        assert r.n_words == r.end - r.start >= 50
    assert {i for i in want if want[i]} == set(got) and all(got[i] <= want[i] for i in got)
    assert sum(map(len, got.values())) >= 0.97 * sum(map(len, want.values()))


def test_repeats_find_a_planted_passage(spark):
    random.seed(9)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    passage = [word() for _ in range(75)]
    rows, spans = [], {}
    for i in range(40):
        before, after = [word() for _ in range(random.randint(0, 60))], [word() for _ in range(random.randint(0, 60))]
        inside = passage if i % 2 else [word() for _ in range(75)]
        spans[i] = (len(before), len(before) + 75)
        rows.append((i, " ".join(before + inside + after), "en", "a"))
    got = {r.doc_id: (r.start, r.end) for r in repeats.repeated_passages(frame(spark, rows)).collect()}
    assert got == {i: s for i, s in spans.items() if i % 2}


def test_repeats_odd_tables(spark, odd, none):
    got = {r.doc_id: (r.start, r.end) for r in repeats.repeated_passages(odd).collect()}
    assert got == {6: (0, 30_000), 10: (0, 30_000), 7: (0, 300), 8: (0, 300), 9: (0, 300)}
    assert repeats.repeated_passages(none).count() == 0


def windows_shared(rows, least=50):
    """doc_id -> places in windows of ``least`` words that another document holds too."""
    words, holders = {i: WORD.findall(t) for i, t, _, _ in rows}, collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - least + 1):
            holders[tuple(w[k : k + least])].add(i)
    found = {i: {p for k in range(len(w) - least + 1) if len(holders[tuple(w[k : k + least])]) > 1 for p in range(k, k + least)} for i, w in words.items()}
    return {i: p for i, p in found.items() if p}


def spans_of(found):
    got = collections.defaultdict(set)
    for r in found.collect():
        got[r.doc_id].update(range(r.start, r.end))
    return got


def test_repeats_find_passages_that_end_in_a_common_footer(spark):
    random.seed(12)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    rows, i = [], 0
    for _ in range(6):
        footer = [word() for _ in range(45)]
        passage = [word() for _ in range(10)] + footer
        for k in range(90):
            inside = passage if k < 2 else [word() for _ in range(10)] + footer
            rows.append((i, " ".join([word() for _ in range(20)] + inside + [word() for _ in range(40)]), "en", "a"))
            i += 1
    want = windows_shared(rows)
    assert len(want) == 12
    assert spans_of(repeats.repeated_passages(frame(spark, rows))) == want


def test_repeats_find_every_place_of_a_passage_that_documents_repeat(spark):
    random.seed(13)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    often, both, few = ([word() for _ in range(100)] for _ in range(3))
    apart = [w for _ in range(3) for w in [*few, *(word() for _ in range(60))]]
    texts = [often * 20, often, both * 20, both * 20, apart, few]
    rows = [(i, " ".join([word() for _ in range(15)] + t + [word() for _ in range(70)]), "en", "a") for i, t in enumerate(texts)]
    want = windows_shared(rows)
    assert [len(want[i]) for i in range(6)] == [2000, 100, 2000, 2000, 300, 100]
    assert spans_of(repeats.repeated_passages(frame(spark, rows))) == want


# --- 7 n-gram join ---------------------------------------------------------------------------------


def brute_links(texts, similarity=0.8):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links, root = collections.Counter(), {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (find(i), links[i]) for i in sets}


def test_ngram_join_against_all_pairs(spark, texts):
    got = {r.doc_id: (r.class_id, r.links) for r in QUERIES["op7_ngram_jaccard_join"](spark, SF).collect()}
    assert got == brute_links(texts)


def test_ngram_join_cuts_large_groups(spark):
    random.seed(4)
    base = ["".join(random.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = {}
    for i in range(60):
        w = list(base)
        for k in random.sample(range(200), random.randint(0, 4)):
            w[k] = "changed"
        rows[i] = " ".join(w)
    df = frame(spark, [(i, t, "en", "a") for i, t in rows.items()])
    got = {r.doc_id: (r.class_id, r.links) for r in ngram_join.similar_classes(df, chunk_docs=7).collect()}
    assert got == brute_links(rows)


def test_choose_bands():
    for recall in (0.9, 0.999):
        bands, rows = ngram_join.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= ngram_join.MOST_HASHES
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 10)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 90), (90, 95), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(2, 31)}, 100: 90, 95: 90}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ngram_join_odd_tables(spark, odd, none):
    rows = ngram_join.similar_classes(odd).collect()
    got = {(r.doc_id, r.class_id, r.links) for r in rows}
    assert len(rows) == len(odd_rows())
    assert {(1, 1, 0), (2, 2, 0), (3, 3, 0), (5, 5, 0), (6, 6, 1), (10, 6, 1), (7, 7, 3), (8, 7, 3), (9, 7, 3), (None, None, 0)} <= got
    assert ngram_join.similar_classes(none).count() == 0


# --- 8 mixing --------------------------------------------------------------------------------------


def test_mixing_reaches_the_targets(spark, docs, texts):
    rows = QUERIES["op8_mix_sources"](spark, SF).join(docs.select("doc_id", "source"), "doc_id").collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        by[r.source].append(r)
    assert math.isclose(sum(v[0].target for v in by.values()), sum(r.size for r in rows))
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2
        assert own[0].target <= 3 * own[0].source_size + 1e-6


def test_mixing_caps_are_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 1)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    total, weight, size = 1111.0, {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}, {"a": 10, "b": 100, "c": 1000, None: 1}
    held: dict = {}
    while True:
        rest = [s for s in size if s not in held]
        share = {s: (total - sum(held.values())) * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * size[s]]
        if not over:
            break
        held.update({s: 3.0 * size[s] for s in over})
    assert got == pytest.approx({**held, **share})


def test_mixing_odd_tables(spark, odd, none):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(odd_rows()) and sorted(map(str, mixing.mix_sources(odd).collect())) == sorted(map(str, rows))
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert counts == collections.Counter({i: n for i in {r.doc_id for r in rows} if (n := sum(r.times for r in rows if r.doc_id == i))})
    assert mixing.mix_sources(none).count() == 0 and mixing.mix_documents(none).count() == 0
    empty = frame(spark, [(1, "", "en", "a"), (2, None, "en", "b")])
    assert {(r.target, r.taken) for r in mixing.mix_sources(empty).collect()} == {(0.0, 0)}


# --- 9 exact dedup ---------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [4, 4096])
@pytest.mark.parametrize("weak", [False, True])
def test_block_naming_is_collision_free(spark, block, weak):
    random.seed(block)
    texts = ["".join(random.choices("ab \n", k=random.randint(0, 40))) for _ in range(150)] + [None, "", " "]
    df = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    digest = (lambda *c: F.pmod(F.xxhash64(*c), F.lit(3)).cast("long")) if weak else F.xxhash64  # a digest that collides at once
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    for r in block_naming.exact_groups(df, block=block, digest=digest).collect():
        group = [i for i, n in enumerate(norm) if n == norm[r.doc_id]]
        best = min(group, key=lambda i: (-len(texts[i] or ""), i))
        assert (r.keep_id, r.group_size, r.kept) == (best, len(group), r.doc_id == best)
        assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()


def test_exact_groups_odd_tables(spark, odd, none):
    rows = block_naming.exact_groups(odd).collect()
    assert len(rows) == len(odd_rows())
    got = {(r.doc_id, r.keep_id, r.group_size) for r in rows}
    assert {(3, 3, 4), (1, 3, 4), (2, 3, 4), (7, 7, 4), (8, 7, 4), (None, 7, 4), (6, 6, 2), (10, 6, 2), (9, 9, 1)} <= got
    kept = block_naming.drop_exact(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 7, 9, 11, 12]
    assert block_naming.exact_groups(none).count() == 0 and block_naming.drop_exact(none).count() == 0


def test_native_operators_have_no_python_in_their_plans(spark, docs):
    for df in (block_naming.exact_groups(docs), fingerprint.fingerprints(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# --- 10 toxicity -----------------------------------------------------------------------------------


def toxic_rows(n=400):
    random.seed(8)
    words = ["".join(random.choices("aeiou", k=1) + random.choices("lmnrst", k=1) + random.choices("aeiou", k=2)) for _ in range(80)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = random.choices(words, k=60)
        if toxic:
            for k in random.sample(range(60), 5):
                text[k] = random.choice(["zorgface", "bluckwit"])
        rows.append((i, " ".join(text), "en", "a"))
        labels.append((i, 0, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    got = toxicity.toxicity_scores(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(held) > 50
    assert all(r.predicted == (r.doc_id % 4 == 0) == (r.score >= 0.5) for r in held)


def test_kneser_ney_against_dictionaries(spark):
    ship(spark)
    data = [(1, "abab bad"), (1, "bad bad"), (0, "abba cab"), (0, "dab a cab"), (0, None)]
    model = toxicity.kneser_ney(spark.createDataFrame(data, "toxic int, text string"))
    order, d = toxicity.ORDER, toxicity.DISCOUNT
    counts = {1: collections.Counter(), 0: collections.Counter()}
    for label, text in data:
        row = "\x00" * (order - 1) + f" {text or ''} ".replace("  ", " ")
        counts[label].update(row[i : i + order] for i in range(len(row) - order + 1))
    level = {order: counts}
    for k in range(order - 1, toxicity.SHARED, -1):
        level[k] = {c: collections.Counter(g[1:] for g in level[k + 1][c]) for c in (0, 1)}
    types = set(level[toxicity.SHARED + 1][0]) | set(level[toxicity.SHARED + 1][1])
    for k in range(toxicity.SHARED, 0, -1):
        pooled = collections.Counter(g[1:] for g in types)
        types, level[k] = set(pooled), {0: pooled, 1: pooled}

    def p(c, g):
        n = level[len(g)][c]
        if len(g) == 1:
            return (max(n[g] - d, 0) + d) / sum(n.values())
        same = [x for x in n if x[:-1] == g[:-1]]
        total = sum(n[x] for x in same)
        return (max(n[g] - d, 0) + d * len(same) * p(c, g[1:])) / total if total else p(c, g[1:])

    def letters(gram):
        out = "".join(chr(gram >> toxicity.SYMBOL_BITS * k & 4095) for k in range(order - 1, -1, -1))
        return out

    rows = model[order][0].collect()
    assert len(rows) == len(set(counts[0]) | set(counts[1]))
    for r in rows:
        g = letters(r.gram)
        assert math.isclose(r.llr, math.log(p(1, g) / p(0, g)), abs_tol=1e-9), g


def test_grams_end_at_every_character():
    grams, owner = toxicity.grams_of(["ab, c", None, "", "Z"])
    text = ["".join(chr(int(g) >> toxicity.SYMBOL_BITS * k & 4095) for k in range(toxicity.ORDER - 1, -1, -1)).replace("\x00", "") for g in grams]
    assert [t for t, o in zip(text, owner, strict=True) if o == 0] == [" ", " a", " ab", " ab ", "ab c", "b c "]
    assert [t for t, o in zip(text, owner, strict=True) if o == 1] == [" "] and owner[-1] == 3


def test_toxicity_odd_tables(spark, odd, none):
    rows, labels = toxic_rows(200)
    odd_labels = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (4, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(frame(spark, rows).union(odd), odd_labels).collect()
    assert len(got) == 200 + len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    no_labels = odd_labels.filter("false")
    assert {r.score for r in toxicity.toxicity_scores(odd, no_labels).collect()} == {0.0}
    assert toxicity.toxicity_scores(none, odd_labels).count() == 0


def test_toxicity_tells_word_pairs_apart(spark):
    random.seed(21)
    vocabulary = ["".join(random.choices("abcdefghij", k=6)) for _ in range(60)]
    rows, labels = [], []
    for i in range(600):
        words = random.choices(vocabulary, k=20)
        a, b = vocabulary[:2] if i % 3 == 0 else vocabulary[1::-1]  # the same words, in the other order
        for k in range(0, 20, 4):
            words[k : k + 2] = [a, b]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(i % 3 == 0)))
    got = toxicity.toxicity_scores(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and all(r.predicted == (r.doc_id % 3 == 0) for r in held)


def test_toxicity_tells_words_of_the_same_strings_apart(spark):
    random.seed(22)
    rows, labels = [], []
    for i in range(600):
        ends = ("fox", "gul") if i % 3 else ("gul", "fox")  # both classes hold the same strings of four letters, equally often
        words = [a + "mirad" + b for a, b in zip(("bet", "kos"), ends, strict=True)] * 6
        filler = ["".join(random.choices("abcdefghij", k=6)) for _ in range(12)]
        rows.append((i, " ".join(w for pair in zip(words, filler, strict=True) for w in pair), "en", "a"))
        labels.append((i, 1, int(i % 3 == 0)))
    got = toxicity.toxicity_scores(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and all(r.predicted == (r.doc_id % 3 == 0) for r in held)


def test_letters_have_symbols_of_their_own(spark):
    letters = [chr(c) for c in range(0x10000) if chr(c).isalpha() and chr(c).lower() == chr(c)]
    grams = toxicity.grams_of(letters)[0].reshape(len(letters), 3)
    assert len(np.unique(grams[:, 1])) == len(letters)
    ship(spark)
    wide = "".join(letters[-400:-200])
    data = [(1, wide), (0, wide[::-1])]
    table = toxicity.score_table(spark.createDataFrame(data, "toxic int, text string")).filter(f"kind > {toxicity.PAIRS}").collect()
    values = {(r.kind, r.key): r.llr for r in table}
    keys = toxicity._lookups([wide])[0]
    assert all((kind, int(g)) in values for kind in range(2 * toxicity.SHARED + 2, 2 * toxicity.ORDER + 2) for g in keys[kind])


def test_toxicity_table_holds_every_key_once(spark):
    ship(spark)
    data = [(1, "x1 bad x1 thing"), (0, "a good thing x2"), (0, None)]
    table = toxicity.score_table(spark.createDataFrame(data, "toxic int, text string")).collect()
    assert len({(r.kind, r.key) for r in table}) == len(table)
    assert sum(r.kind == toxicity.WORDS for r in table) == 6 and sum(r.kind == toxicity.PAIRS for r in table) == 8
    grams = {int(g) for _, t in data for g in toxicity.grams_of([t])[0]}
    assert {r.key for r in table if r.kind == 2 * toxicity.ORDER} == grams


def test_toxicity_leaves_little_on_disk(spark):
    random.seed(31)
    words = ["".join(random.choices("abcd", k=7)) for _ in range(3000)]
    rows = [(i, " ".join(random.choices(words, k=300)), "en", "a") for i in range(600)]  # nearly every pair of words is new
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    kept = lambda: sum(p.stat().st_size for p in Path(spark.conf.get("spark.checkpoint.dir")).rglob("*.parquet"))
    setting, before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"), kept()
    assert toxicity.toxicity_scores(frame(spark, rows), labels).count() == 600
    assert kept() - before < 0.25 * sum(len(r[1]) for r in rows)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_toxicity_asks_with_less_than_a_key_and_gets_the_counts():
    import pyarrow as pa

    random.seed(32)
    words = ["".join(random.choices("abcdefghijklmnop", k=7)) for _ in range(20_000)]
    texts, parts = [" ".join(random.choices(words, k=500)) for _ in range(200)] + [None, ""], 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    chunk = pa.RecordBatch.from_arrays([pa.array([3], pa.int64()), pa.array([_stream(batch)])], names=["chunk", "docs"])
    asked = pa.Table.from_batches(toxicity._asked([chunk], ["doc_id"], parts))
    wanted = toxicity._wanted([toxicity._lookups(texts)])
    n = sum(len(k) for k in wanted.values())
    assert sum(sum(x) for x in asked.column("n").to_pylist()) == n and sum(len(k) for k in asked.column("keys").to_pylist()) < 8 * n
    pairs = wanted[toxicity.PAIRS][::3]
    part = toxicity._part(toxicity.PAIRS, pairs, parts)
    numbers = np.stack([np.arange(len(pairs)) + 1, np.arange(len(pairs)) % 7])
    answers = []
    for p in range(parts):
        table = toxicity._blocks([(p, toxicity.PAIRS, pairs[part == p], numbers[:, part == p])])
        answers.append(toxicity._answered(asked.filter(pa.compute.equal(asked.column("part"), p)), table))
    known = toxicity._gathered(wanted, pa.concat_tables(answers[::-1]), parts)
    assert np.array_equal(known[toxicity.PAIRS][:, ::3], numbers) and not known[toxicity.PAIRS][:, 1::3].any()
    assert not known[toxicity.WORDS].any() and np.isnan(known[2 * toxicity.ORDER].view(np.float64)).all()
    with pytest.raises(ValueError):
        toxicity._gathered(wanted, pa.concat_tables(answers[1:]), parts)


def test_toxicity_finds_distinct_keys_about_as_fast_as_it_sorts_them():
    import time

    keys = np.random.default_rng(33).integers(-(2**63), 2**63, size=400_000)
    keys = np.concatenate([keys, keys[::3]])

    def least(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    wanted = toxicity._wanted([({kind: keys for kind in toxicity.KINDS}, None, None, None)])
    assert wanted[toxicity.PAIRS].tolist() == sorted(set(keys.view(np.uint64).tolist()))
    asked = least(lambda: toxicity._wanted([({kind: keys for kind in toxicity.KINDS}, None, None, None)]))
    assert asked < 8 * len(toxicity.KINDS) * least(lambda: np.sort(keys))


@pytest.mark.parametrize("n", [0, 1, 50, 300_000])  # the last is dealt before it is sorted
def test_toxicity_sums_by_key(n):
    random.seed(34)
    some = [random.getrandbits(64) for _ in range(max(1, n // 3))]
    keys, numbers = np.array(random.choices(some, k=n), dtype=np.uint64), np.random.default_rng(34).integers(0, 9, size=(2, n))
    own, sums, at = toxicity._summed(keys, numbers)
    want = collections.defaultdict(lambda: [0, 0])
    for k, a, b in zip(keys.tolist(), *numbers.tolist(), strict=True):
        want[k][0] += a
        want[k][1] += b
    assert own.tolist() == sorted(want) and np.array_equal(keys[at], own)
    assert sums.T.tolist() == [want[k] for k in own.tolist()]


def test_toxicity_merges_pairs_into_words(n=2000, parts=3):
    import pyarrow as pa

    random.seed(35)
    texts, labels = [" ".join(random.choices("abcdefgh", k=random.randint(0, 9))) for _ in range(n)], [i % 2 for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(texts)], names=["toxic", "text"])
    blocks = pa.Table.from_batches(list(toxicity._count_words([batch], parts)))
    merged = pa.concat_tables(toxicity._merge_pairs(blocks.filter(pa.compute.equal(blocks.column("part"), p)), parts) for p in range(parts))
    pairs, said = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: np.zeros(7, dtype=int))
    for text, toxic in zip(texts, labels, strict=True):
        words = toxicity.word_keys([text])[0].tolist()
        for pair in zip([0, *words], words, strict=False):
            pairs[pair][1 - toxic] += 1
    for (prev, word), (t, o) in pairs.items():
        said[word % 2**64] += [t > 0, o > 0, 1, 0, 0, 0, 0]
        said[prev % 2**64] += [0, 0, 0, t, o, t > 0, o > 0]
    got = collections.defaultdict(lambda: np.zeros(7, dtype=int))
    for part, kind, keys, known in toxicity._unblocked(merged):
        assert (toxicity._part(kind, keys, parts) == part).all()
        if kind == toxicity.WORDS:
            for k, x in zip(keys.tolist(), known.T, strict=True):
                got[k] += x
    assert {k: v.tolist() for k, v in got.items()} == {k: v.tolist() for k, v in said.items()}


def _stream(batch):
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def test_words_lose_the_signs_at_their_ends():
    def hashes(*texts):
        words, counts = toxicity.word_keys(list(texts))
        return words.tolist(), counts.tolist()

    assert hashes("(One) -- two, x.y ... é!", None, "") == hashes("one two\tx.y\né", "", "") and hashes("a -- b")[1] == [2]
    assert hashes("a.\xa0.b")[0] == hashes("a\xa0b")[0] != hashes("a b")[0] and hashes("._.")[0] == hashes("_")[0]


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark, docs):
    at = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = stage(step(spark, at, SF), f"test-{name}")
        assert out.dtypes == docs.dtypes
        before, after = [[r.asDict() for r in x.collect()] for x in (at, out)]
        ids = collections.Counter(r["doc_id"] for r in after)
        if name == "language_id":
            want = {r["doc_id"]: 1 for r in before if any(c.isalpha() for c in r["text"] or "")}
        elif name == "exact_dedup":
            groups = collections.defaultdict(list)
            for r in before:
                groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append((-len(r["text"] or ""), r["doc_id"]))
            want = {min(g)[1]: 1 for g in groups.values()}
        elif name == "ngram_jaccard_join":
            want = {i: 1 for i, (c, _) in brute_links({r["doc_id"]: r["text"] for r in before}).items() if c == i}
        else:
            want = {r.doc_id: r.times for r in mixing.mix_sources(at).collect() if r.times}
        assert ids == want, name
        at = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(library_ids(r.text)) for r in at.select("text").collect())
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == pieces.agg(F.sum("length")).first()[0]


def test_pipeline_odd_tables(spark, odd, none):
    for start, want in ((odd, True), (none, False)):
        at = start
        for name, step in corpus_pipeline.STAGES:
            at = stage(step(spark, at, SF), f"odd-{name}")
        assert (at.count() > 0) == want


def test_query_texts_are_serialisable():
    assert json.dumps(sorted(QUERIES)) and all(callable(q) for q in QUERIES.values())
