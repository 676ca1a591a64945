"""Personal data: fixed patterns, and a character BiLSTM-CRF trained on the spans they label.

The patterns give the base spans, which always stay. The tagger is there for
what they miss: the same kinds of data written otherwise (a number in other
groups, an address spelled out) and secrets. It is fitted on a bounded sample
of labelled windows (``TRAIN_WINDOWS`` with a span and as many without; the
distinct windows with the smallest hashes over all documents), and on twice as many
with generated forms set into them (``pii_forms``), then reads
overlapping windows of every text. Every labelled kind holds a digit, an at sign
or a written-out one, so windows without any (``MARK``) hold no span and are not
decoded. Where windows overlap, each character takes the tag of the window it
stands most central in; the runs of tags over the whole text are grown to
the borders of the words they touch. Those that touch no base span and hold what
their kind must hold (``plausible``: four parts up to 255, a right checksum, a host) are added.

Patterns are searched outwards from the marks that every match must hold, in
time that grows with the text's length, with the results of a plain search.

Cases: null and empty texts have no spans; a text of any length is cut into
windows whole; ids may be null or repeat; where no document has a base span
there is nothing to learn from, and only base spans (none) are returned;
columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarank.llm.bilstm_crf import PAD, Tagger, char_codes
from terrarank.llm.common import byte_batches, materialize, texts_of
from terrarank.llm.pii_forms import FORMS, placed

# Fixed values of the task: the kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Kinds the tagger knows: the fixed ones and secrets, which no fixed pattern finds.
TAGGED = (*KINDS, "secret")
MARK_PATTERN = r"[0-9@]+|[\[( ][Dd][Oo][Tt][\]) ]|[\[(][Aa][Tt][\])]"
MARK = re.compile(MARK_PATTERN)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_WORD = re.compile(r"[^\W_]+")
_LONG_WORD = re.compile(r"[A-Za-z0-9+/=_-]{16,}")

WINDOW, STRIDE = 96, 48
TRAIN_WINDOWS = 600
FORM_ROUNDS = 2
EPOCHS = 14
DECODE_ROWS = 2048  # windows decoded at once
N_TAGS = 1 + 2 * len(TAGGED)  # outside, then begin and inside of each kind


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _passes(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        d = _digits(text)
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(_digits(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each at sign: as far left as the characters before it go, but not into the match before."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        floor = host.end() if host else at + 1
        at = text.find("@", floor)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four groups of digits with single dots between, in the runs of digits and dots."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, start, n = run.group().split("."), run.start(), 0
        while n + 3 < len(parts):
            if all(parts[n:n + 4]):
                end = start + sum(map(len, parts[n:n + 4])) + 3
                yield start, end
                start, n = end + 1, n + 4
            else:
                start, n = start + len(parts[n]) + 1, n + 1


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    if not text or not MARK.search(text):
        return []
    out = []
    for kind in KINDS:
        if kind == "email":
            found = _emails(text)
        elif kind == "ip":
            found = _ips(text)
        elif kind == "phone" and "+" not in text:
            continue
        else:
            found = (m.span() for m in PATTERNS[kind].finditer(text))
        out += [(kind, a, b) for a, b in found if _passes(kind, text[a:b])]
    return out


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a mark or part of one, ascending."""
    found: set[int] = set()
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    for m in MARK.finditer(text):
        low = max(0, (m.start() - WINDOW) // STRIDE * STRIDE + STRIDE)
        found.update(range(low, min((m.end() - 1) // STRIDE * STRIDE, last) + 1, STRIDE))
        # windows further down end before the mark
    return sorted(found)


def tag_array(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int8)
    for kind, start, end in reversed(spans):  # an earlier kind wins where kinds overlap
        tag = 1 + 2 * TAGGED.index(kind)
        tags[start:end] = tag + 1
        tags[start] = tag
    return tags


def spans_of(tags: np.ndarray, offset: int) -> list[tuple[str, int, int]]:
    """Runs of tags as spans; an inside tag of another kind, or after outside, begins a span too."""
    out: list[list] = []
    before = 0
    for i, tag in enumerate(tags.tolist()):
        if tag:
            kind = (tag - 1) // 2
            if tag % 2 or before == 0 or (before - 1) // 2 != kind:
                out.append([TAGGED[kind], offset + i, offset + i])
            out[-1][2] = offset + i + 1
        before = tag
    return [tuple(s) for s in out]


def sample_windows(docs: DataFrame, id_col: str, text_col: str, windows: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A bounded sample of windows with their base spans: ``windows`` with a span and as many without, by smallest hash.

    Each kind has a quota of a fourth of those with a span, so that a frequent kind leaves room for rare ones; what a
    quota leaves over goes to any kind.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text", 8 << 20):
            rows = []
            for text in texts_of(batch):
                if not text or not MARK.search(text):
                    continue
                tags = tag_array(len(text), base_spans(text))
                for s in window_starts(text):
                    piece, own = text[s:s + WINDOW], tags[s:s + WINDOW]
                    cut_off = s and own[0] and not own[0] % 2 or s + WINDOW < len(text) and own[-1] and tags[s + WINDOW] == own[-1] + own[-1] % 2
                    if not cut_off:
                        kinds = sum(1 << k for k in {(t - 1) // 2 for t in own[own > 0].tolist()})
                        rows.append((piece, own.tobytes(), kinds))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int32())], names=["piece", "tags", "kinds"])

    pieces = (docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike(MARK_PATTERN))
              .mapInArrow(cut, "piece string, tags binary, kinds int")
              .groupBy("piece").agg(F.min(F.struct("tags", "kinds")).alias("label"))
              .select(F.xxhash64("piece").alias("h"), "piece", "label.tags", "label.kinds"))
    pieces = materialize(pieces, "pii-windows")  # the patterns are run once
    # few more than wanted pass the thresholds, so that little is sorted and sent, however many tasks there are
    counts = {r.kinds: r["count"] for r in pieces.groupBy("kinds").count().collect()}
    quota = windows // len(KINDS)
    each = [(F.col("kinds").bitwiseAND(1 << k) > 0, quota, sum(n for m, n in counts.items() if m >> k & 1))
            for k in range(len(KINDS))]
    near = F.lit(False)
    for belongs, wanted, n in [*each, (F.col("kinds") > 0, windows, sum(n for m, n in counts.items() if m)),
                               (F.col("kinds") == 0, windows, counts.get(0, 0))]:
        threshold = min(int(min(1.0, (1.2 * wanted + 100) / max(n, 1)) * (1 << 64)) - (1 << 63), (1 << 63) - 1)
        near = near | (belongs & (F.col("h") <= threshold))
    # the thresholds pass about 3.6 * windows + 600 rows; the limit is a bound far above that, so it cuts no kind
    found = pieces.where(near).orderBy("h", "piece").limit(8 * windows + 2000).collect()
    spanned = [r for r in found if r.kinds]
    first = {r.piece for k in range(len(KINDS)) for r in [r for r in spanned if r.kinds >> k & 1][:quota]}
    first |= {r.piece for r in [r for r in spanned if r.piece not in first][:windows - len(first)]}
    rows = [r for r in spanned if r.piece in first] + [r for r in found if not r.kinds][:windows]
    return [(r.piece, spans_of(np.frombuffer(bytes(r.tags), np.int8), 0)) for r in rows]


def _encoded(windows: list[tuple[str, list]]) -> tuple[np.ndarray, np.ndarray]:
    codes, tags = np.full((len(windows), WINDOW), PAD, np.int16), np.zeros((len(windows), WINDOW), np.int8)
    for i, (piece, spans) in enumerate(windows):
        codes[i, :len(piece)] = char_codes(piece)
        tags[i, :len(piece)] = tag_array(len(piece), spans)
    return codes, tags


def labelled_windows(docs: DataFrame, id_col: str, text_col: str, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of the sampled windows."""
    return _encoded(sample_windows(docs, id_col, text_col, windows))


def unlabelled_secret(piece: str, spans: list) -> bool:
    """Whether a window holds what may be a secret, which no pattern labels: it is no example of a window without one."""
    return any(plausible("secret", m.group()) and all(m.end() <= a or m.start() >= b for _, a, b in spans) for m in _LONG_WORD.finditer(piece))


def with_forms(windows: list[tuple[str, list]], seed: int = 5) -> list[tuple[str, list]]:
    """The windows, and each ``FORM_ROUNDS`` times more with a generated form set in (where it has room), kinds in turn."""
    windows = [w for w in windows if not unlabelled_secret(*w)]
    rnd, out = random.Random(seed), list(windows)
    for n, (piece, spans) in enumerate(windows * FORM_ROUNDS):
        kind, make = FORMS[n % len(FORMS)]
        made = placed(piece, spans, kind, make(rnd), rnd, WINDOW)
        if made:
            out.append(made)
    return out


def fit_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               windows: int = TRAIN_WINDOWS) -> Tagger | None:
    """Train on the bounded sample; None where nothing is labelled."""
    sample = sample_windows(docs, id_col, text_col, windows)
    if not any(spans for _, spans in sample):
        return None
    tagger = Tagger(N_TAGS, hidden=24)
    tagger.fit(*_encoded(with_forms(sample)), epochs=EPOCHS, batch=128, rate=0.04)
    return tagger


LONGEST = 320  # characters of an added span: what an address may have

# What a kind must hold, however it is written; groups of digits apart by anything but letters and line breaks.
_PARTS = re.compile(r"[0-9]+")
_DATE = re.compile(r"(19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}")
_WRITTEN_EMAIL = re.compile(r"[\w.%+-]+\s{0,2}(?:@|[\[(]\s?at\s?[\])]|\bat\b)\s{0,2}[\w-]+(?:\s{0,2}(?:\.|[\[(]\s?dot\s?[\])]|\bdot\b)\s{0,2}[\w-]+)+",
                            re.ASCII | re.IGNORECASE)


def plausible(kind: str, piece: str) -> bool:
    """Whether a piece of text can be of the kind."""
    if len(piece) > LONGEST:
        return False
    if kind == "email":
        return bool(_WRITTEN_EMAIL.fullmatch(piece))
    if kind == "secret":
        return len(piece) >= 16 and not re.search(r"\s", piece) and bool(re.search(r"[0-9]", piece)) and bool(re.search(r"[A-Za-z]", piece))
    parts = _PARTS.findall(piece)
    if kind == "ip":
        rest = re.sub(r"[0-9]|dot", "", piece, flags=re.I)
        return len(parts) == 4 and _passes("ip", ".".join(parts)) and not re.search(r"[^\s.\[\]()]", rest)
    if re.search(r"[^\W\d_]|[\r\n]", piece):
        return False
    digits = "".join(parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(_digits(digits))
    if _DATE.fullmatch(piece):
        return False
    return 8 <= len(digits) <= 15 and len(piece) <= 2 * len(digits) + 4 and len(parts) > 1


def fitted(kind: str, text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """The span if it is plausible, else, of numbers that a sum or a count checks, without its first or last group if that is."""
    if plausible(kind, text[start:end]):
        return kind, start, end
    parts = list(_PARTS.finditer(text, start, end)) if kind in ("card", "ip") and end - start <= LONGEST else []
    if len(parts) > 2:
        for a, b in ((parts[1].start(), end), (start, parts[-2].end())):
            if plausible(kind, text[a:b]):
                return kind, a, b
    return None


def to_words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans from the start of the first word they touch to the end of the last; of those that then meet, the longest (first of equals)."""
    words = [m.span() for m in _WORD.finditer(text)] if spans else []
    starts, ends = [a for a, _ in words], [b for _, b in words]
    grown = set()
    for kind, a, b in spans:
        first, last = bisect_right(ends, a), bisect_left(starts, b) - 1
        if first > last:
            continue  # no word in it
        start, end = starts[first], ends[last]
        if kind == "phone" and start and text[start - 1] in "+(":
            start -= 1
            start -= start > 0 and text[start] == "(" and text[start - 1] == "+"
        grown.add((kind, start, end))
    out: list[tuple[str, int, int]] = []
    for s in sorted(grown, key=lambda s: (s[1], -s[2], TAGGED.index(s[0]))):
        if out and s[1] < out[-1][2]:
            if s[2] - s[1] > out[-1][2] - out[-1][1]:
                out[-1] = s
            continue
        out.append(s)
    return out


def model_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """The tagger's spans of each text, reconciled over overlapping windows."""
    starts = [window_starts(t) for t in texts]
    where = [(i, s) for i, own in enumerate(starts) for s in own]
    # characters of each window that stand most central in it: its middle half, and what no neighbour covers
    tags = {}
    for at in range(0, len(where), DECODE_ROWS):
        part = where[at:at + DECODE_ROWS]
        codes = np.full((len(part), WINDOW), PAD, np.int16)
        for row, (i, s) in enumerate(part):
            piece = texts[i][s:s + WINDOW]
            codes[row, :len(piece)] = char_codes(piece)
        for key, row in zip(part, tagger.decode(codes)):
            tags[key] = row
    out = []
    for i, (text, own) in enumerate(zip(texts, starts)):
        spans, run, run_start = [], [], 0
        edge = (WINDOW - STRIDE) // 2
        for n, s in enumerate(own):
            follows = n > 0 and own[n - 1] == s - STRIDE
            leads = n + 1 < len(own) and own[n + 1] == s + STRIDE
            if not follows:
                if run:
                    spans += spans_of(np.concatenate(run), run_start)
                run, run_start = [], s
            a = edge if follows else 0
            b = WINDOW - edge if leads else min(WINDOW, len(text) - s)
            run.append(tags[i, s][a:b])
        if run:
            spans += spans_of(np.concatenate(run), run_start)
        out.append([x for s in to_words(text, spans) if (x := fitted(s[0], text, s[1], s[2]))])
    return out


def merge_spans(base: list[tuple[str, int, int]], added: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and the added ones that touch none of them, by kind, then start."""
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], []
    for _, b in taken:
        reach.append(max(b, reach[-1]) if reach else b)  # how far the spans up to here go

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or reach[before - 1] <= a

    return sorted({*base, *(x for x in added if free(x[1], x[2]))}, key=lambda x: (TAGGED.index(x[0]), x[1], x[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             windows: int = TRAIN_WINDOWS) -> DataFrame:
    """One row per document: id, base counts by kind, base digest, all spans, spans added by the model, number of all spans."""
    tagger = fit_tagger(docs, id_col, text_col, windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, text_col, 8 << 20):
            texts = [t or "" for t in texts_of(batch, text_col)]
            base = [base_spans(t) for t in texts]
            marked = [i for i, t in enumerate(texts) if MARK.search(t)]
            added: dict[int, list] = {}
            if tagger is not None:
                added = dict(zip(marked, model_spans([texts[i] for i in marked], tagger)))
            merged = [merge_spans(b, added.get(i, [])) for i, b in enumerate(base)]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base]),
                 pa.array([written(m) for m in merged]),
                 pa.array([len(m) - len(b) for m, b in zip(merged, base)], pa.int64()),
                 pa.array([len(m) for m in merged], pa.int64())],
                names=[id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, "
             "base_sha256 string, spans string, n_added long, n_spans long")
