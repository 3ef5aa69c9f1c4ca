"""Personal data by boosted trees over candidate spans.

Base rules find email addresses, IP addresses, card and phone numbers of strict form.
Beside them generators propose spans that overlap each other and miss little: every
stretch around an at sign or a word that stands for one, and every row of neighbouring
digit groups of fitting size, so that two numbers side by side, of which a base rule makes
one that fails its check, are proposed one by one too. Gradient-boosted trees rate a
candidate by its form (digits, groups, separators, check digit, parts of an address) and
its context (neighbouring letters and numbers, cue words); a threshold per kind, read off
counted scores, selects what is added to the base spans.

No labels are given, so the base rules teach: a candidate that is a base span is a
positive, one that fails the checks of its kind a negative. What a base rule cannot see is
learnt from copies of the context of base spans with the span rewritten (spelled-out
signs, other separators, a second number next to it), and with numbers that are no
personal data (dates, versions, amounts, lists) in its place. Candidates inside a base
span, and those that would pass but for their spelling, teach nothing.

The trees are fitted on the candidates of about ``FIT_DOCS`` documents, at most
``FIT_ROWS`` rows, chosen by hash. All other documents are scored for the thresholds: the
least at which the share of negatives among what is selected stays under ``WRONG``.

A candidate within a base span or within another selected one of its kind is not added.
Secrets such as keys and passwords are no kind of personal data here.

Defined cases: a null text has no spans; a null doc_id is kept; repeated rows are handled
one by one; an empty table, or one without any base span, gets base spans only; other
columns are not looked at. Every search is linear in the length of the text, also on a
text that is one long number or word.
"""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds, in the order of the result.
KINDS = ("email", "ip", "card", "phone")
FIT_DOCS, FIT_ROWS = 20_000, 60_000
WRONG = 0.005
BINS = 200  # of scores
Span = tuple[int, int, int]  # kind, start, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"(?<![0-9])(?<![0-9]\.)[0-9]++(?:\.[0-9]++){3,}+")
PART = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(int(d) * 2 - 9 * (d > "4") for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(map(str, map(unicodedata.decimal, filter(str.isdecimal, text))))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part reaches back from the at sign, so no start is tried twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in DOTTED.finditer(text):
        parts = list(PART.finditer(text, *chain.span()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0]) <= 255 for p in four):
                yield four[0].start(), four[3].end()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        if 16 <= found.end() - found.start() <= 37:
            digits = found[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text):
        if 8 <= sum(map(str.isdecimal, found[0])) <= 15:
            yield found.span()


def base_spans(text: str) -> list[Span]:
    """All spans of strict form, by kind and start."""
    return [(k, s, e) for k, find in enumerate((emails, addresses, cards, phones)) for s, e in find(text)]


# -- candidates ---------------------------------------------------------------------

GROUP = re.compile(r"\d+")
#: What may stand between two groups of one number.
GAP = re.compile(r"[    ().\-/+‐-–]{1,3}|\[\.\]|\(\.\)| ?[\[(]dot[\])] ?| dot ")
OPENING = re.compile(r"[+(]{1,2}$")
MOST_GROUPS = 8
AT = re.compile(r" ?[(\[{<] ?(?:at|At|AT|@) ?[)\]}>] ?| at | ?@ ?")
MARK = re.compile(r"[(\[{<] ?(?:at|At|AT|@) ?[)\]}>]")
STOPS = frozenset("<>()[]{}\",;:|@ \t\n\r\v\f ")
HOST = re.compile(r"[^\W_][\w-]{0,62}+(?:(?: ?[(\[{<] ?(?:dot|Dot|DOT|\.) ?[)\]}>] ?| dot |\.)[^\W_][\w-]{0,62}+)++")
DOT = re.compile(r" ?[(\[{<] ?(?:dot|Dot|DOT|\.) ?[)\]}>] ?| dot |\.")
LONGEST_NAME = 64  # letters before an at sign, as mail allows
CUES = re.compile(
    r"(e-?mail|mailto|contact|write to|courriel|correo)|(\bip\b|host|server|address|adresse)|(card|visa|carte|karte|tarjeta|pay)|(phone|tel\b|call|fax|mobile|telefon|tél)",
    re.I,
)
AROUND = 24


def number_candidates(text: str) -> Iterator[Span]:
    groups = [m.span() for m in GROUP.finditer(text)]
    gaps = [None] * len(groups)
    for i in range(len(groups) - 1):
        (_, end), (start, _) = groups[i], groups[i + 1]
        if start - end <= 7 and GAP.fullmatch(text, end, start):
            gaps[i] = text[end:start]
    for i, (start, end) in enumerate(groups):
        if end - start > 19 or (start and text[start - 1].isalpha()):
            continue
        lead = OPENING.search(text, max(start - 2, 0), start)
        total, dots = 0, True
        for j in range(i, min(i + MOST_GROUPS, len(groups))):
            total += groups[j][1] - groups[j][0]
            end = groups[j][1]
            if total > 19:
                break
            if not (end < len(text) and text[end].isalpha()):
                if j == i + 3 and dots:
                    yield 1, start, end
                if total >= 12:
                    yield 2, start, end
                if 7 <= total <= 15 and (j > i or lead):
                    yield 3, lead.start() if lead else start, end
            if j + 1 == len(groups) or gaps[j] is None:
                break
            dots = dots and "." in gaps[j] or dots and "dot" in gaps[j]


def email_candidates(text: str) -> Iterator[Span]:
    places = {m.start() for m in MARK.finditer(text)}
    for sign in ("@", " at "):
        at = text.find(sign)
        while at >= 0:
            places.add(at)
            at = text.find(sign, at + 1)
    for place in sorted(places):
        found = AT.match(text, place - 1) if place and text[place - 1] == " " else None
        found = found or AT.match(text, place)
        if not found:
            continue
        start = end = found.start()
        while start and end - start < LONGEST_NAME and text[start - 1] not in STOPS:
            start -= 1
        host = HOST.match(text, found.end())
        if start < end and host:
            yield 0, start, host.end()


def candidates(text: str) -> list[Span]:
    return sorted({*email_candidates(text), *number_candidates(text)})


def plain_form(kind: int, raw: str) -> str:
    """The span as the base rules would have it written."""
    if kind:
        return raw
    place = AT.search(raw)
    return raw[: place.start()] + "@" + DOT.sub(".", raw[place.end() :]) if place else raw


def letter_class(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdecimal() else 3 if c.isalpha() else 4 if c in ".,;:!?" else 5


FEATURES = 33


def features(text: str, span: Span) -> list[float]:
    """Form and context of a candidate."""
    kind, start, end = span
    raw = text[start:end]
    groups = GROUP.findall(raw)
    digits = digits_of(raw)
    sizes = [len(g) for g in groups] or [0]
    between = re.sub(r"\d", "", raw)
    before, after = text[max(start - AROUND, 0) : start], text[end : end + AROUND]
    out = [
        kind, len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], sizes[1] if len(sizes) > 1 else 0,
        max((int(g) if len(g) < 5 else 9999) for g in groups) if groups else 0, float(bool(digits) and luhn(digits)),
        raw.startswith("+") or raw.startswith("(+"), "(" in raw and ")" in raw, between.count("."), between.count("-"), between.count("/"),
        sum(map(str.isspace, between)), len(set(between) - {"+", "(", ")"}), len(raw),
    ]
    if kind == 0:
        name, _, host = plain_form(0, raw).rpartition("@")
        labels = host.split(".")
        out += [len(name), len(labels), len(labels[-1]), labels[-1].isalpha(), labels[-1].islower(), len(labels[0]), "@" in raw, "." in name or any(map(str.isdecimal, name))]
    else:
        out += [0] * 8
    cue = 0
    for found in CUES.finditer(before):
        cue = cue or found.lastindex == kind + 1
    out += [
        letter_class(before[-1:]), letter_class(after[:1]),
        # Numbers next to the span, so near that they may belong to it.
        any(map(str.isdecimal, before[-2:])), any(map(str.isdecimal, after[:2])),
        sum(map(str.isdecimal, before)), sum(map(str.isdecimal, after)), cue,
    ]
    return [float(x) for x in out]


# -- what the trees learn from -------------------------------------------------------


def fails(kind: int, raw: str) -> bool:
    """Whether no spelling would make a base span of it."""
    digits, groups = digits_of(raw), GROUP.findall(raw)
    if kind == 1:
        return len(groups) != 4 or any(len(g) > 3 or int(g) > 255 for g in groups)
    if kind == 2:
        return not 16 <= len(digits) <= 19 or not luhn(digits)
    if kind == 3:
        return not 8 <= len(digits) <= 15
    return False


def labelled(text: str, truth: list[Span], whole: bool = False) -> Iterator[tuple[Span, int]]:
    """Candidates that are a span of ``truth`` or surely none. ``whole``: the truth is all
    there is, so whatever it does not hold is none."""
    known = set(truth)
    for span in candidates(text):
        kind, start, end = span
        if span in known:
            yield span, 1
            continue
        near = [t for t in truth if t[1] < end and start < t[2]]
        if any(s <= start and end <= e for _, s, e in near):
            continue
        if kind == 0 and any(k == 0 and start <= s and e <= end for k, s, e in near):
            continue
        if whole or near or fails(kind, text[start:end]):
            yield span, 0


def rewritten(kind: int, raw: str, rng: random.Random) -> str:
    """The same datum, spelled so that the base rules may miss it."""
    if kind == 0:
        name, _, host = raw.partition("@")
        at = rng.choice(["@", " (at) ", "(at)", " [at] ", " at ", " @ ", " {at} "])
        dot = rng.choice([".", " dot ", " [dot] ", "(dot)", "."])
        return name + at + host.replace(".", dot)
    if kind == 1:
        return raw.replace(".", rng.choice([".", "[.]", "(.)", " . ", " dot "]))
    digits = digits_of(raw)
    if kind == 2:
        sign = rng.choice(["", " ", "-", ".", " ", "  "])
        return sign.join(digits[i : i + 4] for i in range(0, len(digits), 4)) if len(digits) == 16 else sign.join((digits[:4], digits[4:10], digits[10:]))
    if rng.random() < 0.3:
        return raw
    sign = rng.choice([" ", "-", ".", " ", "/"])
    tail = digits[-10:]
    local = rng.choice([f"({tail[:-7]}) {tail[-7:-4]}{sign}{tail[-4:]}", sign.join((tail[:-7], tail[-7:-4], tail[-4:]))])
    lead = digits[:-10]
    return rng.choice([local, f"+{lead or 1}{sign}{local}", f"00{lead or 1} {local}", f"{lead or 1}{sign}{local}"])


def no_datum(rng: random.Random) -> str:
    """A number or phrase that is nobody's."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    y, m, d = rng.randint(1000, 2099), rng.randint(1, 12), rng.randint(1, 31)
    return rng.choice(
        [
            f"{y}-{m:02}-{d:02}", f"{d:02}/{m:02}/{y}", f"{d}.{m}.{y}", f"{y}-{m:02}-{d:02} {n(2)}:{n(2)}", f"{y}-{m:02}-{d:02} {d:02} {n(4)}",
            f"{n(1)}.{n(2)}.{n(1)}", f"{n(1)}.{n(2)}.{n(3)}.{n(4)}", f"{n(2)}.{n(1)}.{n(1)}.{n(1)}.{n(1)}", f"{y}-{y + rng.randint(1, 99)}", f"{y} {y + 1} {y + 2} {n(3)}",
            f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{n(1)} {n(3)} {n(3)} {n(3)}", f"{n(2)}.{n(4)} {n(1)}.{n(4)}", " ".join(n(rng.randint(1, 3)) for _ in range(6)),
            " ".join(n(rng.randint(1, 6)) for _ in range(rng.randint(2, 7))), "-".join(n(rng.randint(1, 7)) for _ in range(rng.randint(2, 5))),
            n(rng.randint(7, 19)), f"({n(2)}) {n(5)} {n(4)}", f"{n(3)} / {n(4)}", f"+{n(2)} {n(2)}", f"+{n(1)}.{n(6)}", f"{n(4)} {n(4)} {n(4)}", f"{n(3)}.{n(3)}.{n(3)},{n(2)}",
            f"was at {rng.choice(['home', 'noon', 'sea', 'work'])}.{rng.choice(['The', 'And', 'He', 'They'])}", "a@b", f"look at {n(1)}.{n(1)}", "x @ y.Z1",
        ]
    )


def lessons(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and labels out of a text: its own candidates, and copies of the context
    of each base span with something else in its place."""
    truth = base_spans(text)
    for span, label in labelled(text, truth):
        yield features(text, span), label
    for kind, start, end in truth:
        raw, rng = text[start:end], random.Random(zlib.crc32(text[start:end].encode()))
        left, right = text[max(start - 40, 0) : start], text[end : end + 40]
        # Other spans nearby would be taken for what they are not.
        left, right = (" " if base_spans(x) or GROUP.search(x) or "@" in x else x for x in (left, right))
        other = rng.choice(truth)
        pieces = [
            [(kind, rewritten(kind, raw, rng))],
            [(kind, rewritten(kind, raw, rng))],
            [(kind, raw), (other[0], text[other[1] : other[2]])],
            [(None, no_datum(rng))],
            [(None, no_datum(rng))],
            [(None, no_datum(rng)), (kind, raw)],
        ]
        for piece in pieces:
            copy, spans = left, []
            for i, (k, written) in enumerate(piece):
                copy += " " if i else ""
                if k is not None:
                    spans.append((k, len(copy), len(copy) + len(written)))
                copy += written
            for span, label in labelled(copy + right, spans, True):
                yield features(copy + right, span), label


# -- boosted trees ---------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: per inner node a feature and a cut (greater goes
    right), per leaf a value."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of every row."""
        if not len(x):
            return np.zeros(0)
        trees, depth = np.arange(len(self.feature))[None, :], int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(depth):
            right = x[rows, self.feature[trees, node]] > self.cut[trees, node]
            node = 2 * node + 1 + right
        return 1 / (1 + np.exp(-self.start - self.leaf[trees, node - self.feature.shape[1]].sum(1)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, smooth: float = 1.0, bins: int = 32) -> Trees:
    """Second-order boosting of the logistic loss over binned features; rows are few, as
    the sample is bounded."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    margin = np.full(len(y), np.log(share / (1 - share)))
    inner = 2**depth - 1
    trees = Trees(np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1)), float(margin[0]))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h, node = p - y, p * (1 - p), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain = np.full(width, 1e-9)
            for f, c in enumerate(cuts):
                slot = (node - first) * (len(c) + 1) + binned[:, f]
                G, H = (np.bincount(slot, w, width * (len(c) + 1)).reshape(width, -1).cumsum(1) for w in (g, h))
                for i, limit in enumerate(c):
                    gl, hl, ga, ha = G[:, i], H[:, i], G[:, -1], H[:, -1]
                    better = gl**2 / (hl + smooth) + (ga - gl) ** 2 / (ha - hl + smooth) - ga**2 / (ha + smooth)
                    better[(hl < 1) | (ha - hl < 1)] = 0  # too few rows on a side
                    won = np.flatnonzero(better > gain)
                    gain[won], trees.feature[t, first + won], trees.cut[t, first + won] = better[won], f, limit
            node = 2 * node + 1 + (x[np.arange(len(x)), trees.feature[t, node]] > trees.cut[t, node])
        G, H = (np.bincount(node - inner, w, inner + 1) for w in (g, h))
        trees.leaf[t] = -rate * G / (H + smooth)
        margin += trees.leaf[t][node - inner]
    return trees


@dataclass(frozen=True)
class Model:
    trees: Trees | None
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Selected candidates that no base span and no other selected one holds."""
        if self.trees is None:
            return []
        spans = candidates(text)
        # A base span that a candidate lies in begins at or before it.
        spans = without_inner(spans, base)
        if not spans:
            return []
        scores = self.trees.score(np.array([features(text, s) for s in spans], np.float32))
        chosen = [s for s, p in zip(spans, scores.tolist()) if p >= self.thresholds[s[0]]]
        best = {s: p for s, p in zip(spans, scores.tolist())}
        return apart(chosen, best)


def without_inner(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that lie within no base span of any kind."""
    starts = sorted((s, e) for _, s, e in base)
    reach, out, i = -1, [], 0
    for span in sorted(spans, key=lambda s: (s[1], s[2])):
        while i < len(starts) and starts[i][0] <= span[1]:
            reach = max(reach, starts[i][1])
            i += 1
        if span[2] > reach:
            out.append(span)
    return out


def apart(spans: list[Span], score: dict[Span, float]) -> list[Span]:
    """Of overlapping spans the best rated, then the longest, then the first; what it
    overlaps goes, whatever its kind."""
    out: list[Span] = []
    cluster: list[Span] = []
    reach = -1

    def settle() -> None:
        taken: list[Span] = []
        for s in sorted(cluster, key=lambda s: (-round(score[s], 3), s[1] - s[2], s[1], s[0])):
            if all(s[2] <= t[1] or t[2] <= s[1] for t in taken):
                taken.append(s)
        out.extend(taken)

    for span in sorted(spans, key=lambda s: s[1]):
        if span[1] >= reach and cluster:
            settle()
            cluster = []
        cluster.append(span)
        reach = max(reach, span[2]) if len(cluster) > 1 else span[2]
    settle()
    return sorted(out)


# -- over a table ------------------------------------------------------------------------


def sampled(docs: DataFrame, bound: int) -> Column:
    """Whether a row is learnt from: about ``bound`` of them, and no more than four fifths
    however few there are."""
    share = min(0.8, bound / max(docs.count(), 1))
    return F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))


def lesson_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (x, y)."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            rows = list(lessons(text))
            for at in range(0, len(rows), 10_000):
                xs, ys = zip(*rows[at : at + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(list(xs), pa.list_(pa.float32())), pa.array(ys, pa.int32())], names=["x", "y"])


def score_task(trees: Trees):
    """(text) to (kind, bin, y, n): how many of its lessons score how high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(KINDS) * (BINS + 1) * 2, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows = list(lessons(text))
                if rows:
                    x, y = (np.array(c, np.float32) for c in zip(*rows))
                    slot = (x[:, 0].astype(np.int64) * (BINS + 1) + (trees.score(x) * BINS).astype(np.int64)) * 2 + y.astype(np.int64)
                    counts += np.bincount(slot, minlength=len(counts))
        slot = np.flatnonzero(counts)
        columns = [slot // 2 // (BINS + 1), slot // 2 % (BINS + 1), slot % 2, counts[slot]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["kind", "bin", "y", "n"])

    return run


def threshold(counts: list[tuple[int, int, int]]) -> float:
    """Of (bin, y, n): the least score at which negatives stay rare among what scores as
    much or more. Without a positive nothing is selected."""
    right = wrong = 0
    least = 2.0
    for b in range(BINS, -1, -1):
        right += sum(n for at, y, n in counts if at == b and y)
        wrong += sum(n for at, y, n in counts if at == b and not y)
        if right and wrong <= WRONG * (right + wrong):
            least = max(b / BINS, 0.5)
    return least


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_rows: int = FIT_ROWS) -> Model:
    """Trees from a bounded sample, thresholds from all other documents."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    mine = sampled(texts, fit_docs)
    rows = texts.where(mine).mapInArrow(lesson_task, "x array<float>, y int")
    # At most ``fit_rows`` rows of ``FEATURES`` floats.
    rows = rows.orderBy(F.xxhash64("x"), "x", "y").limit(fit_rows).toArrow()
    y = rows.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return Model(None)
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    trees = fit_trees(x, y)
    scored = texts.where(~mine).mapInArrow(score_task(trees), "kind long, bin long, y long, n long")
    # One row per kind, bin and label.
    counts = scored.groupBy("kind", "bin", "y").agg(F.sum("n").alias("n")).collect()
    by_kind = [[(r.bin, r.y, r.n) for r in counts if r.kind == k] for k in range(len(KINDS))]
    return Model(trees, tuple(map(threshold, by_kind)))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, the number of base spans by kind, their digest, all spans as text, and
    ``n_added``, one row per row of (doc_id, text)."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                added = model.added(text or "", base)
                kinds = [k for k, _, _ in base]
                out.append((*(kinds.count(k) for k in range(len(KINDS))), hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), len(added)))
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * len(types), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets."""
    model, at = model or fit(docs), docs.columns.index("text")

    def cut(text: str | None) -> str | None:
        if not text:
            return text
        base, parts, done = base_spans(text), [], 0
        for kind, start, end in sorted(base + model.added(text, base), key=lambda s: (s[1], -s[2])):
            if end > done:
                parts += [text[done:start], f"[{KINDS[kind]}]"] if start >= done else []
                done = end
        return "".join(parts) + text[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([cut(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, "text", texts)

    return docs.mapInArrow(run, docs.schema)
