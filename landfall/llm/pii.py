"""Personal data: fixed formats, and further identifiers by bootstrapped contextual extraction.

Whatever matches a fixed format is a seed. The words around seeds are patterns; the strings around which a
pattern occurs are its instances. Spark scores both in turn: a pattern by the share of its distinct instances
that are trusted to be of a kind, an instance by the patterns that are. Patterns that end up with a high score
and enough trusted instances mark the other identifier-like strings they surround, which no format matches.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
TRUST = 0.8  # a pattern's score from which it marks instances
SUPPORT = 5  # distinct trusted instances a pattern needs
LONGEST = 64  # characters of an identifier-like string
NEAR = 80  # characters on each side in which the words of a pattern are looked for

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\s]+")
_MORE = re.compile(r"(?: [0-9().+-]+)*")
_WORD = re.compile(r"[^\W\d_]+|[:=#]")


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(int(d) if i % 2 == 0 else double[int(d)] for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, leftmost and non-overlapping for each kind, by start, then kind.

    A match that fails its further condition is dropped and not tried again from within. Every pattern
    here reads the text once, whatever it holds.
    """
    if not _ANY.search(text):
        return []
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            done = domain.end()
            found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(start, end, KINDS[kind]) for start, kind, end in sorted(found)]


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Identifier-like strings outside ``taken``: four digits at least, or an at sign inside."""
    out, busy, last, k = [], sorted((s, e) for s, e, _ in taken), 0, 0
    for mark in _ANY.finditer(text):
        if mark.start() < last:
            continue
        start = mark.start()
        while start > last and not text[start - 1].isspace() and mark.start() - start < LONGEST:
            start -= 1
        token = _TOKEN.match(text, start, start + 2 * LONGEST)
        end = _MORE.match(text, token.end(), token.end() + LONGEST).end()
        last = max(end, mark.end())
        raw = text[start:end]
        lead = len(raw) - len(raw.lstrip("\"'([{<,;:."))
        raw = raw.strip("\"'([{<>}]),;:.!?&%$#*")
        start, end = start + lead, start + lead + len(raw)
        if len(raw) > LONGEST or not (sum(c.isdigit() for c in raw) >= 4 or "@" in raw[1:-1]):
            continue
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        if not any(s < end and e > start for s, e in busy[max(0, k - 4) : k + 4]):
            out.append((start, end))
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a string: two words before, one before and one after, three before."""
    before = _WORD.findall(text[max(0, start - NEAR) : start].lower())
    after = _WORD.findall(text[end : end + NEAR].lower())
    out = []
    if len(before) >= 2:
        out.append(f"{before[-2]} {before[-1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    if len(before) >= 3:
        out.append(f"{before[-3]} {before[-2]} {before[-1]} _")
    return out


def _extract(batches):
    """One row per document: its number, base spans, and everything the graph needs."""
    import pyarrow as pa
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    link = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
    for b in batches:
        rows, counts, shas, spans, links = [], [], [], [], []
        for value in b.column(1):
            text = value.as_py() or ""
            base = base_spans(text)
            joined = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
            seen = [(s, e, k) for s, e, k in base] + [(s, e, None) for s, e in candidates(text, base)] if base or _ANY.search(text) else []
            rows.append(row)
            row += 1
            counts.append([sum(k == kind for _, _, k in base) for kind in KINDS])
            shas.append(hashlib.sha256(joined.encode()).hexdigest())
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k in base])
            links.append([{"start": s, "end": e, "kind": k, "instance": text[s:e].lower(), "patterns": patterns(text, s, e)} for s, e, k in seen])
        numbers = np.array(counts, dtype=np.int64).reshape(-1, 4)
        arrays = [b.column(0), pa.array(rows, pa.int64()), *(pa.array(numbers[:, i]) for i in range(4)), pa.array(shas, pa.string()), pa.array(spans, pa.list_(span)), pa.array(links, pa.list_(link))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "links"])


_SPAN = "struct<start:long,end:long,kind:string>"
_LINK = "struct<start:long,end:long,kind:string,instance:string,patterns:array<string>>"


def bootstrap(links: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, score) that are trusted and (instance, kind, score), from (kind, instance, pattern) rows.

    Each round is two joins on the pattern-instance graph, whose sums are combined before they are shuffled.
    Seeds keep the score 1; an instance in several trusted patterns has 1 - product(1 - score).
    """
    edges = stage(links.select("pattern", "instance").distinct(), "pii-edges")
    seeds = stage(links.filter("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0)), "pii-seeds")
    degree = stage(edges.groupBy("pattern").agg(F.count("*").alias("degree")), "pii-degree")
    known, trusted = seeds, None
    for k in range(rounds):
        mass = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        scored = mass.filter(F.col("mass") >= support).join(degree, "pattern").select("pattern", "kind", (F.col("mass") / F.col("degree")).alias("score"))
        trusted = stage(scored.filter(F.col("score") >= trust), f"pii-patterns-{k}")
        if trusted.isEmpty():
            break
        doubt = F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999))))
        reached = edges.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        known = stage(seeds.union(reached.join(seeds, ["instance", "kind"], "left_anti")), f"pii-instances-{k}")
    return trusted, known


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found, found.

    The counts and the digest are of the fixed formats; ``spans`` also has what the patterns discovered, of
    the kind of their seeds, as kind:start:end by start, then kind; ``found`` has only that. Ends are
    exclusive, places are code points. Null text is empty and has no spans. Null and repeated doc_ids are
    treated row by row; equal rows have equal spans. Other columns are ignored.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    made = base.mapInArrow(_extract, f"doc_id long, row long, {counts}, base_sha256 string, spans array<{_SPAN}>, links array<{_LINK}>")
    made = stage(made, "pii-rows")
    links = made.select("row", F.explode("links").alias("l")).select("row", "l.start", "l.end", "l.kind", "l.instance", F.explode("l.patterns").alias("pattern"))
    trusted, known = bootstrap(links, trust=trust, support=support)
    marked = links.filter("kind is null").drop("kind").join(trusted.select("pattern", "kind"), "pattern").join(known, ["instance", "kind"]).filter(F.col("score") >= trust)
    best = marked.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    found = stage(best.groupBy("row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("found")), "pii-found")
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    order = lambda spans: F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("s"), rank(x).alias("r"), x["end"].alias("e"), x["kind"].alias("k"))))
    text_of = lambda spans: F.array_join(F.transform(order(spans), lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    more = F.coalesce(F.col("found"), F.array().cast(f"array<{_SPAN}>"))
    out = made.drop("links").join(found, "row", "left").withColumn("more", more)
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", text_of(F.concat("spans", "more")).alias("spans"), F.size("more").cast("long").alias("n_found"), text_of(F.col("more")).alias("found"))
