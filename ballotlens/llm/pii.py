"""Personal data by candidate gradient boosting.

Four base patterns (email, ip, card, phone) give spans that always stay.
High-recall generators propose further, overlapping candidates (obfuscated
addresses, numbers without a plus sign, other separators); boosted trees score
them by format and context features and calibrated thresholds, one per kind,
decide. What lies outside base spans is not taken for wrong: the trees learn, on
all such candidates of the table, to tell base
spans and rewritten forms of base spans (without plus sign, with dots, with
"(at)") from non-data: base spans rewritten into failed Luhn numbers, dates,
versions and the like, and candidates that are such by their form. One
threshold holds for all kinds: the lowest score (rounded down to 1/``LEVELS``) at which
the share of right ones among rewritten spans and non-data at or above it, as expected
from them ((right + 1/2) / (n + 1)), is ``PRECISION``. All rows count, each scored by trees
that have not seen its label (three folds by hash); non-data by form is never added.
Rows with equal features are counted together, and the trees of all folds grow at
once from sums over them, which Spark takes over parts of about ``PART_ROWS`` different
rows; only such sums reach the driver. The
generators bound numbers by their formats; names and hosts have any length.
Where added spans overlap each other or a base span, the better one stays.

Offsets are code points, ends are exclusive. Counts are those of the base
spans. Defined cases: a null or empty text has no spans; repeated rows and rows
with a null doc_id are treated like any other; an empty table gives an empty
result; other columns are ignored."""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ballotlens.llm import boosting
from ballotlens.llm import common as C

PRECISION = 0.99
FOLDS = 3
LEVELS = 1 << 16            # of scores, for the threshold
PART_ROWS = 50_000          # different rows that a task learns from, about
CONTEXT = 40

# fixed values: the kinds in order and their base patterns
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")       # a match can only begin at the first digit of a run
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_GENERATORS = (
    # possessive runs: a match begins where a run does, and every run is read once
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]++ ?(?:@|\(at\)|\[at\]| at ) ?[\w-]++"
                         r"(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[\w-]++)*+")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:[.,][0-9]{1,4}){3}(?![0-9])")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./()-]{1,2}[0-9]{2,5}){1,5}(?![0-9])")),
)
_SENTENCE = re.compile(r"(?<! )\. ")
_HOST = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_DATE = re.compile(r"(?:19|20)\d\d[-./ ]\d{1,2}[-./ ]\d{1,2}(?: \d\d)?|\d{1,2}[-./ ]\d{1,2}[-./ ](?:19|20)?\d\d"
                   r"|(?:19|20)\d\d[-/ ]{1,2}(?:19|20)\d\d")
_HINTS = (("mail", "write", "contact", "reach"), ("ip", "host", "server", "login"),
          ("card", "visa", "credit", "pay"), ("phone", "call", "tel", "mobile", "fax"),
          ("isbn", "version", "order", "invoice", "page", "date", "total", "price"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _plain_address(span: str) -> str:
    return re.sub(r" ?(?:\(at\)|\[at\]| at ) ?", "@", re.sub(r" ?(?:\(dot\)|\[dot\]| dot | \. ) ?", ".", span))


def non_data(kind: int, span: str) -> bool:
    """Whether a candidate cannot be personal data of its kind by its form."""
    digits = _digits(span)
    if kind == 0:
        return not _HOST.fullmatch(_plain_address(span).partition("@")[2])
    if kind == 1:                           # eight groups, or four numbers of 255 at most
        return span.count(":") != 7 if ":" in span else not all(_small(p) for p in re.findall(r"[0-9]+", span))
    if kind == 2:
        return not luhn(digits)
    isbn = len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(d) * (1 + 2 * (i % 2)) for i, d in enumerate(digits)) % 10 == 0
    return isbn or bool(_DATE.fullmatch(span)) or (len(digits) < 9 and bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){2,}", span)))


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of a candidate and its context."""
    digits = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    plain = _plain_address(span)
    domain = plain.partition("@")[2]
    left, right = before[-1:], after[:1]
    near = before.lower()
    side = lambda c: 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0
    return [float(kind == k) for k in range(4)] + [
        float(len(span)), float(len(digits)), float(len(groups)), float(max(groups)), float(min(groups)), float(groups[0]),
        float(groups[-1]), float(len(set(digits))), float(12 <= len(digits) <= 19 and luhn(digits)),
        float(len(groups) == 4 and all(_small(p) for p in re.findall(r"[0-9]+", span))), float(span.count(".")),
        float(span.count(":")), float("(" in span), float("@" in plain), float("." in domain),
        float(len(domain.rpartition(".")[2])), float(len(plain.partition("@")[0])),
        float(9 <= len(digits) <= 15), float(digits[:1] in ("4", "5", "3", "6")), side(left), side(right),
    ] + [float(any(w in near for w in words)) for words in _HINTS]


def _rewritten(kind: int, span: str) -> list[str]:
    """Other ways to write a base span."""
    digits = _digits(span)
    if kind == 0:
        return [span.replace("@", " (at) ").replace(".", " (dot) "), span.replace("@", " at ").replace(".", " dot "),
                span.replace("@", " [at] ")]
    if kind == 1:
        a, b, c, d = (int(p) for p in span.split("."))
        return [f"0000:0000:0000:0000:0000:ffff:{a:02x}{b:02x}:{c:02x}{d:02x}"]
    if kind == 2:
        return [sep.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for sep in "./"]
    return [span.lstrip("+"), "00" + span.lstrip("+"), re.sub(r"[ ().-]+", ".", span.lstrip("+")),
            f"{digits[-10:-7]} {digits[-7:-4]} {digits[-4:]}".strip()]


def _mistaken(kind: int, span: str) -> list[str]:
    """Non-data made of a base span."""
    digits = _digits(span)
    if kind == 0:
        local, _, domain = span.partition("@")
        return [f"{local} at {domain.partition('.')[0]}", f"{local}@{domain.partition('.')[0]}", f"{local} at {domain.partition('.')[0]}.30"]
    if kind == 1:
        return [re.sub(r"[0-9]+$", lambda m: str(int(m.group()) + 256), span),
                ",".join(str(int(p) + 256) for p in span.split("."))]
    if kind == 2:
        wrong = span[:-1] + str((int(span[-1]) + 1) % 10)
        return [wrong, ".".join(_digits(wrong)[i:i + 4] for i in range(0, len(digits), 4))]
    month, day, year = 1 + int(digits[-1]), 10 + int(digits[-2]), digits[-4:-2]
    body = "978" + digits[-9:].rjust(9, "0")
    check = -sum(int(d) * (1 + 2 * (i % 2)) for i, d in enumerate(body)) % 10
    return [f"20{year}-{month:02d}-{day}", f"{day}.{month:02d}.20{year}", f"{day}.{year}.{digits[-3:]}",
            f"{body[:3]}-{body[3]}-{body[4:7]}-{body[7:]}-{check}"]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Proposed spans with features. label: 1 for a base span, 0 for non-data,
    2 (unknown) for any other that touches no base span, null for one that
    overlaps a base span without being it; start -1 marks rewritten base spans,
    as data (1) or as non-data (0), for learning only."""
    out, exact = [], set(base)
    around = lambda a, b: (text[max(0, a - CONTEXT):a], text[b:b + 8])
    borders = sorted((a, b) for a, _, b in base)
    starts, reach = [a for a, _ in borders], list(accumulate((b for _, b in borders), max))
    seen = set()
    for name, pattern in _GENERATORS:
        kind = KINDS.index(name)
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == 0 and (stop := _SENTENCE.search(text, a, b)):     # an address ends with its sentence
                b = stop.start()
            span = text[a:b]
            if (a, kind, b) in seen or (name == "phone" and not 7 <= len(_digits(span)) <= 15):
                continue
            seen.add((a, kind, b))
            k = bisect_left(starts, b)
            touches = k > 0 and reach[k - 1] > a
            out.append({"kind": kind, "start": a, "end": b, "features": features(kind, span, *around(a, b)),
                        "label": 1 if (a, kind, b) in exact else None if touches else 0 if non_data(kind, span) else 2})
    for a, kind, b in base:
        for label, others in ((1, _rewritten(kind, text[a:b])), (0, _mistaken(kind, text[a:b]))):
            out += [{"kind": kind, "start": -1, "end": -1, "features": features(kind, x, *around(a, b)), "label": label} for x in others]
    return out


_FOUND = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())]))),
    ("proposed", pa.list_(pa.struct([("kind", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                                     ("features", pa.list_(pa.float64())), ("label", pa.int64())])))])
_FOUND_SQL = ("doc_id long, base array<struct<start long, kind long, end long>>, proposed array<struct<kind long, "
              "start long, end long, features array<double>, label long>>")
_SIGN = C.byte_class(b"0123456789@")


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.text_slices(batches, "text"):
        data, offsets = C.text_buffers(part.column("text"))
        signs = np.concatenate([[0], np.cumsum(_SIGN[data])])
        some = signs[offsets[1:]] > signs[offsets[:-1]]
        rows = []
        for doc_id, text, sign in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), some):
            base = base_spans(text) if text and sign else []      # every base pattern needs a sign
            rows.append({"doc_id": doc_id, "base": [{"start": a, "kind": k, "end": b} for a, k, b in base],
                         "proposed": candidates(text, base) if text else []})
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)


def calibrate(scores: np.ndarray, labels: np.ndarray, precision: float, counts: np.ndarray | None = None) -> float:
    """The lowest score at which the expected share of positives among those at
    or above it, (positives + 1/2) / (n + 1), is at least ``precision``; infinity if
    there is none. The same rule at every size: few rows leave the share uncertain.
    ``counts``: how often each row is there."""
    counts = np.ones(len(scores)) if counts is None else counts
    order = np.argsort(-scores, kind="stable")
    right = (np.cumsum((labels * counts)[order]) + 0.5) / (np.cumsum(counts[order]) + 1)
    last = np.append(scores[order][1:] != scores[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(scores[order][good[-1]]) if len(good) else float("inf")


def _by_level(block: dict) -> np.ndarray:
    """Rows that are calibrated on by (label, score rounded down), each scored by
    the model of its own fold."""
    scores, out = boosting._sigmoid(block["total"]), np.zeros((2, LEVELS + 1), np.int64)
    for y in (0, 1):
        rows = block["calibrated"] & (block["y"] == y)
        for f in range(FOLDS):
            own = block["counts"][rows, FOLDS] - block["counts"][rows, f]       # what fold f's model has not seen
            out[y] += np.bincount((scores[rows, f] * LEVELS).astype(np.int64), own, LEVELS + 1).astype(np.int64)
    return out


def _learned(rows: boosting.Near | boosting.Spread, edges: list[np.ndarray], base: list[float]) -> tuple[dict, float]:
    """Trees and the threshold, from rows that the model of each fold counts
    but for that fold, and the last model counts whole."""
    model = boosting.grow(rows, edges, base)[FOLDS]
    found = rows.sums(_by_level)
    y, level = np.nonzero(found)
    return model, max(0.5, calibrate(level / LEVELS, y.astype(float), PRECISION, found[y, level]))


def _model_counts(folds: np.ndarray) -> np.ndarray:
    """(rows, FOLDS + 1) counts of the models from counts by fold."""
    whole = folds.sum(axis=1, keepdims=True)
    return np.concatenate([whole - folds, whole], axis=1)


def _bases(right: np.ndarray, n: np.ndarray) -> list[float]:
    return [boosting.base_of(r / max(c, 1)) for r, c in zip(right.tolist(), n.tolist())]


def learn(x: np.ndarray, y: np.ndarray, rewritten: np.ndarray) -> tuple[dict | None, float]:
    """Trees and the threshold. Every row is scored by trees of the other folds;
    rewritten base spans and non-data are calibrated on."""
    if len(set(y)) < 2:
        return None, float("inf")
    counts = _model_counts(np.eye(FOLDS, dtype=np.int64)[np.arange(len(y)) % FOLDS])
    edges, base = boosting.quantile_edges(x), _bases(counts[y == 1].sum(axis=0), counts.sum(axis=0))
    block = boosting.block_of(boosting.bin_codes(x, edges), y, counts, np.array(base))
    return _learned(boosting.Near({**block, "calibrated": rewritten | (y == 0)}), edges, base)


def _choose(base: list[dict], proposed: list[dict], scores: np.ndarray, limit: float) -> list[tuple[int, int, int]]:
    """Added spans, best first, that overlap nothing taken before."""
    reach = 0
    taken = []                                  # disjoint (start, end), sorted: base spans joined where they overlap
    for a, b in sorted((b["start"], b["end"]) for b in base):
        if taken and a < reach:
            taken[-1] = (taken[-1][0], max(reach, b))
        else:
            taken.append((a, b))
        reach = taken[-1][1]
    added = []
    for i in np.argsort(-scores, kind="stable"):
        c = proposed[i]
        if c["start"] < 0 or c["label"] != 2 or scores[i] < limit:
            continue
        k = bisect_left(taken, (c["end"],))
        if k == 0 or taken[k - 1][1] <= c["start"]:
            insort(taken, (c["start"], c["end"]))
            added.append((c["start"], c["kind"], c["end"]))
    return added


def _learn_from(found: DataFrame) -> tuple[dict | None, float]:
    """Trees and the threshold from all proposed spans with labels."""
    known = found.filter(F.size("proposed") > 0).select("doc_id", F.explode("proposed").alias("c")).filter("c.label in (0, 1)")
    fold = F.pmod(F.xxhash64("doc_id", "c"), F.lit(FOLDS))
    names = [f"n{f}" for f in range(FOLDS)]
    counted = C.stored(
        known.select("c.features", "c.label", (F.col("c.start") < 0).alias("rewritten"), fold.alias("fold"))
        .groupBy("features", "label", "rewritten").agg(*[F.count_if(F.col("fold") == f).alias(n) for f, n in enumerate(names)]), "pii-known")
    sums = {r.label: r for r in counted.groupBy("label").agg(F.count("*").alias("rows"), *[F.sum(n).alias(n) for n in names]).collect()}
    if len(sums) < 2:
        return None, float("inf")
    folds = np.array([[sums[y][n] for n in names] for y in (0, 1)], np.int64)
    base = _bases(_model_counts(folds)[1], _model_counts(folds).sum(axis=0))
    places = [float(q) for q in np.linspace(0, 1, boosting.BINS)[1:-1]]
    at = (counted.select(F.posexplode("features").alias("feature", "x"), sum(map(F.col, names)).alias("n"))
          .groupBy("feature", "x").agg(F.sum("n").alias("n"))
          .groupBy("feature").agg(F.percentile("x", F.array(*map(F.lit, places)), F.col("n")).alias("at")).orderBy("feature").collect())
    edges = [np.unique(np.array(r["at"])) for r in at]

    def block(batch: pa.RecordBatch) -> dict:
        x = np.array(batch.column("features").flatten(), float).reshape(len(batch), -1)
        counts = _model_counts(np.stack([batch.column(n).to_numpy() for n in names], axis=1))
        y = batch.column("label").to_numpy().astype(float)
        made = boosting.block_of(boosting.bin_codes(x, edges), y, counts, np.array(base))
        return {**made, "calibrated": (y == 0) | batch.column("rewritten").to_numpy(zero_copy_only=False)}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block(batch))], pa.binary())], names=["made"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [block(batch) for batch in batches]
        near = boosting.Near({k: np.concatenate([m[k] for m in made]) for k in made[0]})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_learned(near, edges, base))], pa.binary())], names=["made"])

    parts = -(-sum(r["rows"] for r in sums.values()) // PART_ROWS)
    dealt = counted.repartition(parts)
    if parts == 1:              # as many as one task takes anyway: no job for each level of each tree
        return pickle.loads(bytes(dealt.mapInArrow(whole, "made binary").first().made))
    rows = boosting.Spread(dealt.mapInArrow(blocks, "made binary").rdd.map(lambda r: pickle.loads(r.made)))
    try:
        return _learned(rows, edges, base)
    finally:
        rows.done()


def _decided(bases: list[list[dict]], proposals: list[list[dict]], model: dict | None,
             limit: float) -> list[list[tuple[int, int, int]]]:
    """Base and added spans of each text."""
    rows = [c["features"] for p in proposals for c in p]
    scores = boosting.predict(model, np.array(rows, float)) if model and rows else np.zeros(len(rows))
    at, out = 0, []
    for base, proposed in zip(bases, proposals):
        own, at = scores[at:at + len(proposed)], at + len(proposed)
        out.append(sorted([(b["start"], b["kind"], b["end"]) for b in base] + _choose(base, proposed, own, limit)))
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, kind, end), ordered by start and
    kind number; ``spans`` holds the base spans and the added ones."""
    found = C.stored(C.id_text(docs, id_col, text_col).mapInArrow(_propose, _FOUND_SQL), "pii-candidates")
    model, limit = _learn_from(found)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = _decided(batch.column("base").to_pylist(), batch.column("proposed").to_pylist(), model, limit)
            spans = [[dict(zip(("start", "kind", "end"), s)) for s in x] for x in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(spans, _FOUND.field("base").type)],
                names=["doc_id", "base", "spans"])

    kind = "array<struct<start long, kind long, end long>>"
    return found.select("doc_id", "base", "proposed").mapInArrow(decide, f"doc_id long, base {kind}, spans {kind}")


def without_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns, with personal data replaced
    in the texts; ``length_col``, if there is such a column, follows the text."""
    base_col, proposed_col = C.unused_name(docs, "base_spans"), C.unused_name(docs, "proposed_spans")
    columns = [_FOUND.field("base"), _FOUND.field("proposed")]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.text_slices(batches, text_col):
            named = pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.int64()), part.column(text_col)], names=["doc_id", "text"])
            found = pa.Table.from_batches(_propose(iter([named])), _FOUND).combine_chunks()
            spans = [found.column(f.name).combine_chunks() for f in columns]
            spans = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in spans]
            yield pa.RecordBatch.from_arrays([*part.columns, *spans], names=[*part.schema.names, base_col, proposed_col])

    kinds = dict(zip((base_col, proposed_col), _FOUND_SQL.split(", base ", 1)[1].split(", proposed ")))
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in kinds.items())).fields])
    rows = C.stored(C.small_batches(docs).mapInArrow(propose, schema), "pii-documents")
    model, limit = _learn_from(rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(proposed_col).alias("proposed")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.text_slices(batches, text_col):
            part = batch.select([n for n in batch.schema.names if n not in (base_col, proposed_col)])
            spans = _decided(batch.column(base_col).to_pylist(), batch.column(proposed_col).to_pylist(), model, limit)
            if not any(spans):
                yield part
                continue
            texts = [redact(t, s) if s else t for t, s in zip(part.column(text_col).to_pylist(), spans)]
            arrays = [pa.array(texts, f.type) if f.name == text_col else part.column(i) for i, f in enumerate(part.schema)]
            if length_col in part.schema.names:
                i = part.schema.get_field_index(length_col)
                sizes = [len(t) if s else n for t, s, n in zip(texts, spans, part.column(i).to_pylist())]
                arrays[i] = pa.array(sizes, part.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)

    return rows.mapInArrow(run, docs.schema)


def joined(spans: str):
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, (s["kind"] + 1).cast("int")), s["start"].cast("string"), s["end"].cast("string"))))


def digest_table(found: DataFrame) -> DataFrame:
    """Counts of base spans, SHA-256 of the joined base spans, all spans joined."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *[count(k) for k in range(4)],
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by the kind of its
    first span in capitals and brackets."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
