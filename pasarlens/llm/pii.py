"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Fixed patterns give the base spans of emails, addresses, cards and phones.  Generators with a high
recall propose further, overlapping spans: any chain of digits and the windows of whole digit groups
inside it, spelled-out emails, addresses with other separators.  Format and context features of a candidate go to gradient-boosted trees, trained
on all candidates whose label the patterns give: a base span is positive, a chain
that cannot be of its kind is negative, and one of the right shape that only fails a check (the
Luhn sum, the leading plus) is left out of the training.  The threshold is set on a fifth of them that
the trees have not seen.  Base spans always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches, stage
from pasarlens.operators.ranking import running_total

KINDS = ("email", "ip", "card", "phone")
TREES = 20
DEPTH = 4
# Precision the threshold must reach on held-out candidates.
PRECISION = 0.995
# Context looked at on either side, and the longest whole chain proposed: no kind fills more (19 digits, 2 signs between).
CONTEXT = 24
LONGEST = 64

# Fixed patterns.  Possessive where the greedy form could only fail slower.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

CHAIN = re.compile(r"[+(]?[0-9](?:[ ().\-/:]{0,2}[0-9])*+")
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,40}(?:"
    r" ?@ ?[A-Za-z0-9-]{1,40}(?: ?\. ?[A-Za-z0-9-]{1,20}){1,3}"
    r"| ?[(\[{]at[)\]}] ?[A-Za-z0-9-]{1,40}(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]{1,20}){1,3}"
    r"| at [A-Za-z0-9-]{1,40}(?: dot [A-Za-z0-9-]{1,20}){1,3})",
    re.I,
)
# Texts without any of these have no candidates.
MAYBE = re.compile(r"@|[0-9]|[(\[{]at[)\]}]| at [^ ]{1,40} dot ", re.I)
SIGN = re.compile(r"@|[(\[{]at[)\]}]| dot ", re.I)
# Words before a span that speak for or against it.
CUES = re.compile(r"(?:tel|phone|call|fax|mobile|cell|card|visa|credit|account|iban|e-?mail|mail|contact|ip|host|server|addr)", re.I)
AGAINST = re.compile(r"(?:version|licen[sc]e|v|no|isbn|token|key|id|page|section|chapter|figure|year|\$|€|%|=)\W*$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(span: str) -> str:
    return "".join(c for c in span if c.isascii() and c.isdigit())


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from the @ outwards (linear in the text)."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The fixed patterns' spans by kind; a match that fails its check is dropped."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    spans["email"] = emails(text)
    for match in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.group().split(".")):
            spans["ip"].append(match.span())
    for match in CARD.finditer(text):
        digits = digits_of(match.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans["card"].append(match.span())
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(digits_of(match.group())) <= 15:
                spans["phone"].append(match.span())
    return spans


def _shape(kind: str, span: str) -> bool:
    """Could the candidate be of its kind, checks apart?"""
    digits = digits_of(span)
    groups = re.findall(r"[0-9]+", span)
    if kind == "email":
        return bool(re.search(r"[A-Za-z]{2,}$", span))
    if kind == "ip":
        return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups) and "(" not in span and "+" not in span
    if kind == "card":
        return 13 <= len(digits) <= 19 and "+" not in span
    grouped = len(groups) >= 3 and len(groups[-1]) >= 2 and not re.fullmatch(r"[0-9]+(?:\.[0-9]+)+", span)
    return 9 <= len(digits) <= 15 and (span.startswith("+") or grouped)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = digits_of(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    last = before[-1:] or " "
    following = after[:1] or " "
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(span)), float(len(digits)), float(sum(map(str.isalpha, span))), float(len(groups)),
        float(max(groups)), float(min(groups)), float(groups[-1]),
        float(span.count(".")), float(span.count("-")), float(span.count(" ")), float(span.count("/") + span.count(":")),
        float("(" in span), float(span.startswith("+")), float("@" in span), float(digits[:1] == "0"),
        float(last.isalnum()), float(following.isalnum()), float(last.isspace()), float(last in "\"'="),
        float(following.isspace() or following in ".,;!?"), float(bool(CUES.search(before))),
        float(bool(AGAINST.search(before))), float(sum(map(str.isdigit, before + after))),
    ]


def windows(text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """Parts of a chain, of whole digit groups, that could be of a kind: ``kind, start, end``.

    Cards pass the check sum; phones begin with the plus; addresses and phones without one hold no white
    space and stand between it.  A group has a digit at least, so a start has at most 19 windows.
    """
    groups = [m.span() for m in re.compile("[0-9]+").finditer(text, start, end)]
    out = []
    for i, (a, _) in enumerate(groups):
        while a > start and text[a - 1] in "+(":
            a -= 1
        count = 0
        for j in range(i, len(groups)):
            z = groups[j][1]
            count += z - groups[j][0]
            if count > 19:
                break
            if (a, z) == (start, end):
                continue
            span = text[a:z]
            alone = " " not in span and (a == start or text[a - 1] == " ") and (z == end or text[z] == " ")
            if j - i == 3 and alone and _shape("ip", span):
                out.append((1, a, z))
            if count >= 13 and "+" not in span and luhn(digits_of(span)):
                out.append((2, groups[i][0], z))
            if 9 <= count <= 15 and (span.startswith("+") or alone and _shape("phone", span)):
                out.append((3, a, z))
    return out


def _meets(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Does one of the sorted, disjoint spans overlap this one?"""
    k = bisect_left(spans, (end,))
    return k > 0 and spans[k - 1][1] > start


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[dict]:
    """Proposed spans with their features; ``label`` is 1, 0, or -1 where the patterns cannot tell."""
    proposed = {(KINDS.index(kind), a, z) for kind in KINDS for a, z in base[kind]}
    known = set(proposed)
    parts: set[tuple[int, int, int]] = set()
    for match in SPELLED.finditer(text) if SIGN.search(text) else ():
        proposed.add((0, *match.span()))
    for match in CHAIN.finditer(text):
        a, z = match.span()
        parts.update(windows(text, a, z))
        if z - a > LONGEST:
            continue
        for kind in (1, 2, 3):
            if kind != 1 or text.count(".", a, z) or text.count(":", a, z):
                proposed.add((kind, a, z))
    parts -= proposed
    out = []
    for kind, a, z in sorted(proposed | parts):
        if (kind, a, z) in known:
            label = 1
        elif _meets(base[KINDS[kind]], a, z):
            continue  # a variant of a span that stays anyway
        else:
            taken = any(_meets(base[k], a, z) for k in KINDS)
            if taken and (kind, a, z) in parts:
                continue
            label = -1 if (kind, a, z) in parts else 0 if taken or not _shape(KINDS[kind], text[a:z]) else -1
        out.append({"kind": kind, "start": a, "end": z, "label": label, "f": features(text, kind, a, z)})
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in sorted(spans))


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays, one row of nodes per tree; a leaf has feature -1."""

    weights: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    threshold: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t, weight in enumerate(self.weights):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = self.feature[t, at]
                below = x[rows, np.maximum(f, 0)] <= self.limit[t, at]
                at = np.where(f < 0, at, np.where(below, self.left[t, at], self.right[t, at]))
            total += weight * self.value[t, at]
        return total


def _as_arrays(model) -> tuple[np.ndarray, ...]:
    size = 2 ** (DEPTH + 1)
    n = len(model.treeWeights)
    feature, limit, value = np.full((n, size), -1), np.zeros((n, size)), np.zeros((n, size))
    left, right = np.zeros((n, size), int), np.zeros((n, size), int)
    for t, tree in enumerate(model.trees):
        nodes = [tree._call_java("rootNode")]
        for k, node in enumerate(nodes):
            value[t, k] = node.prediction()
            if node.subtreeDepth():
                feature[t, k] = node.split().featureIndex()
                limit[t, k] = node.split().threshold()
                left[t, k], right[t, k] = len(nodes), len(nodes) + 1
                nodes += [node.leftChild(), node.rightChild()]
    return np.array(model.treeWeights), feature, limit, left, right, value


def train(found: DataFrame) -> Trees | None:
    """Trees and threshold from ``found(cands)``; none if the candidates are all of one label.

    Four fifths of all labelled candidates train the trees, the others calibrate the threshold.
    """
    every = found.select(F.explode("cands").alias("c"), "place").where("c.label >= 0")
    held = F.pmod(F.xxhash64("place", "c.kind", "c.start", "c.end"), F.lit(5)) == 0
    labelled = stage(every.select(F.col("c.label").cast("double").alias("label"), F.col("c.f").alias("f"), held.alias("held")), "labelled")
    fitting = stage(labelled.where("NOT held").select("label", array_to_vector("f").alias("features")), "labelled")
    if fitting.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(fitting)
    trees = Trees(*_as_arrays(model), threshold=0.0)

    @F.pandas_udf("double")
    def margin(features: pd.Series) -> pd.Series:
        return pd.Series(trees.margin(np.array(features.tolist(), float)) if len(features) else [], dtype="float64")

    below = (-margin("f")).alias("below")
    tested = labelled.where("held").select(below, F.col("label").cast("long").alias("label")).groupBy("below")
    tested = stage(tested.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")), "labelled")
    if tested.isEmpty():
        return None
    enough = F.col("cum_right") >= PRECISION * F.col("cum_n")
    lowest = running_total(tested, "below", ["n", "right"]).where(enough).agg(F.max("below")).first()[0]
    # not below even odds, however well the held-out part looks
    return replace(trees, threshold=np.inf if lowest is None else max(-lowest, 0.0))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` for every row of ``docs``.

    ``base`` and ``spans`` list ``kind:start:end`` in code points, end exclusive, by kind and start:
    the spans of the fixed patterns (counted in ``n_``), and those with what the trees add.  An added span
    does not overlap another.  Null texts are empty and have no spans.  Ids may be null or repeat:
    rows are looked at one by one.  Without candidates of both labels nothing is added.  An empty table
    stays empty.  Other columns are not looked at.
    """

    @F.pandas_udf(
        "n array<long>, base string, "
        "cands array<struct<kind:int,start:int,end:int,label:int,f:array<double>>>"
    )
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            if not text or not MAYBE.search(text):
                rows.append(([0] * len(KINDS), "", []))
                continue
            base = base_spans(text)
            spans = [(k, a, z) for k, kind in enumerate(KINDS) for a, z in base[kind]]
            rows.append(([len(base[kind]) for kind in KINDS], written(spans), candidates(text, base)))
        return pd.DataFrame(rows, columns=["n", "base", "cands"])

    found = stage(
        lean_batches(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("place"), find("text").alias("p")).select("doc_id", "place", "p.*"),
        "candidates",
    )
    trees = train(found)

    @F.pandas_udf("string")
    def select(base: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for known, cands in zip(base, lists):
            if trees is None or cands is None or not len(cands):
                out.append(known)
                continue
            spans = [(c["kind"], c["start"], c["end"]) for c in cands if c["label"] == 1]
            new = [c for c in cands if c["label"] == -1]
            if new:
                margins = trees.margin(np.array([np.asarray(c["f"], float) for c in new]))
                for k in np.argsort(-margins, kind="stable"):
                    c = new[k]
                    if margins[k] >= trees.threshold and not any(a < c["end"] and c["start"] < z for _, a, z in spans):
                        spans.append((c["kind"], c["start"], c["end"]))
            out.append(written(spans))
        return pd.Series(out, dtype=object)

    return found.select(
        "doc_id",
        *[F.get("n", F.lit(k)).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        "base",
        select("base", "cands").alias("spans"),
    )

