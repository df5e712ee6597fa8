"""Personal data in texts: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans of every whole text.  The model, trained in numpy from labelled spans, adds spans
that the patterns miss, such as telephone numbers without a plus sign.  Every kind needs a digit or an at sign, so the
model reads overlapping windows around these characters only; what the windows decode is put together per text,
each position taken from the window in whose middle it lies most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import sampled, whole_text

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW, STRIDE, MARGIN = 64, 32, 24
#: Windows that the model is trained on at most, and the least mean posterior of a span that it adds.
TRAIN_WINDOWS, TRAIN_CANDIDATES, SURE = 3000, 6000, 0.9
HIDDEN, EMBEDDED = 16, 8

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the run of address characters before it and a domain behind it: one pass, whatever the run."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            end = at + 1
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _TRIGGER.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(d) <= 3 and int(d or "0") <= 255 for d in (p.lstrip("0") for p in m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# characters: digits and letters as classes, other ASCII characters as themselves
_PUNCTUATION = [chr(c) for c in range(32, 127) if not chr(c).isalnum()]
CLASSES = 5 + len(_PUNCTUATION)
_CLASS = np.full(128, 4, dtype=np.int64)
for _c in range(128):
    _CLASS[_c] = 1 if chr(_c).isdigit() else 2 if chr(_c).islower() else 3 if chr(_c).isupper() else 4
for _k, _p in enumerate(_PUNCTUATION):
    _CLASS[ord(_p)] = 5 + _k


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 2)  # 0 is padding


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool):
    """x: steps x batch x inputs.  Hidden states of all steps, and what the way back needs."""
    steps, size = x.shape[:2]
    n = u.shape[0]
    h, c = np.zeros((size, n), x.dtype), np.zeros((size, n), x.dtype)
    out, kept = np.empty((steps, size, n), x.dtype), []
    pre = x @ w + b
    for t in range(steps):
        z = pre[t] + h @ u
        i, f, o = np.split(_sigmoid(z[:, : 3 * n]), 3, axis=1)
        g = np.tanh(z[:, 3 * n:])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            kept.append((i, f, o, g, before, squashed, h))
        h = o * squashed
        out[t] = h
    return out, kept


def _lstm_back(x, w, u, kept, d_out):
    d_w, d_u, d_b, d_x = np.zeros_like(w), np.zeros_like(u), np.zeros(w.shape[1], w.dtype), np.empty_like(x)
    d_h, d_c = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
    for t in reversed(range(len(x))):
        i, f, o, g, before, squashed, h = kept[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - squashed**2)
        d_z = np.concatenate(
            [d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g**2)], axis=1)
        d_w += x[t].T @ d_z
        d_u += h.T @ d_z
        d_b += d_z.sum(0)
        d_x[t] = d_z @ w.T
        d_h, d_c = d_z @ u.T, d_c * f
    return d_w, d_u, d_b, d_x


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Embedding, one LSTM each way, a linear layer and a chain of tags."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"e": draw(CLASSES, EMBEDDED)}
        for way in "fb":
            self.p |= {f"w{way}": draw(EMBEDDED, 4 * HIDDEN), f"u{way}": draw(HIDDEN, 4 * HIDDEN), f"b{way}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{way}"][HIDDEN:2 * HIDDEN] = 1  # forget gates start open
        self.p |= {"o": draw(2 * HIDDEN, TAGS), "ob": np.zeros(TAGS, np.float32), "t": np.zeros((TAGS, TAGS), np.float32)}
        # a tag inside a kind follows only the begin or inside of that kind
        self.allowed = np.zeros((TAGS, TAGS), np.float32)
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            self.allowed[[x for x in range(TAGS) if x not in (inside, inside - 1)], inside] = -1e4

    def emissions(self, x: np.ndarray, keep: bool = False):
        """x: windows x steps of classes.  Scores: steps x windows x tags."""
        p, e = self.p, self.p["e"][x.T]
        forth, kept_f = _lstm(e, p["wf"], p["uf"], p["bf"], keep)
        back, kept_b = _lstm(e[::-1], p["wb"], p["ub"], p["bb"], keep)
        h = np.concatenate([forth, back[::-1]], axis=2)
        return h @ p["o"] + p["ob"], (e, h, kept_f, kept_b)

    def posteriors(self, em: np.ndarray):
        """Marginals of tags and of pairs summed over steps, by the forward and backward sums of the chain."""
        chain, steps = self.p["t"] + self.allowed, len(em)
        first = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0) * (np.arange(TAGS) > 0)  # no window begins inside
        alpha, beta = np.empty_like(em), np.zeros_like(em)
        alpha[0] = em[0] + first
        for t in range(1, steps):
            alpha[t] = em[t] + _logsumexp(alpha[t - 1][:, :, None] + chain, 1)
        for t in reversed(range(steps - 1)):
            beta[t] = _logsumexp(chain + (em[t + 1] + beta[t + 1])[:, None, :], 2)
        whole = _logsumexp(alpha[-1], 1)
        return alpha, beta, whole, chain

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
        """Gradients and loss of a batch of windows x and tags y."""
        em, (e, h, kept_f, kept_b) = self.emissions(x, keep=True)
        alpha, beta, whole, chain = self.posteriors(em)
        size, steps = x.shape
        weight = (x.T > 0).astype(np.float32)[:, :, None] / size
        d_em = np.exp(np.minimum(alpha + beta - whole[:, None], 0))
        np.put_along_axis(d_em, y.T[:, :, None], np.take_along_axis(d_em, y.T[:, :, None], 2) - 1, 2)
        d_em *= weight
        d_t = np.zeros_like(self.p["t"])
        for t in range(steps - 1):
            d_t += np.exp(np.minimum(alpha[t][:, :, None] + chain + (em[t + 1] + beta[t + 1])[:, None, :] - whole[:, None, None], 0)).sum(0)
        np.subtract.at(d_t, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        d_h = d_em @ self.p["o"].T
        grad = {"o": np.tensordot(h, d_em, axes=([0, 1], [0, 1])), "ob": d_em.sum((0, 1)), "t": d_t / size}
        grad["wf"], grad["uf"], grad["bf"], d_e = _lstm_back(e, self.p["wf"], self.p["uf"], kept_f, d_h[:, :, :HIDDEN])
        grad["wb"], grad["ub"], grad["bb"], d_r = _lstm_back(e[::-1], self.p["wb"], self.p["ub"], kept_b, d_h[::-1, :, HIDDEN:])
        grad["e"] = np.zeros_like(self.p["e"])
        np.add.at(grad["e"], x.T, d_e + d_r[::-1])
        return grad, float(-np.take_along_axis(d_em, y.T[:, :, None], 2).sum())

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.01) -> Tagger:
        rng = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        n = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                some, n = order[at:at + batch], n + 1
                grad, _ = self.step(x[some], y[some])
                size = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (size + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= (rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (Viterbi) and their posteriors: windows x steps each."""
        em, _ = self.emissions(x)
        alpha, beta, whole, chain = self.posteriors(em)
        steps, size = em.shape[:2]
        first = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0) * (np.arange(TAGS) > 0)
        score, came = em[0] + first, np.empty((steps, size, TAGS), np.int8)
        for t in range(1, steps):
            every = score[:, :, None] + chain
            came[t] = every.argmax(1)
            score = every.max(1) + em[t]
        tags = np.empty((steps, size), np.int64)
        tags[-1] = score.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = np.take_along_axis(came[t], tags[t][:, None], 1)[:, 0]
        posterior = np.exp(np.minimum(np.take_along_axis(alpha + beta - whole[:, None], tags[:, :, None], 2)[:, :, 0], 0))
        return tags.T, posterior.T


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that cover the surroundings of every digit and at sign."""
    starts, covered = [], -1
    for m in _TRIGGER.finditer(text):
        if m.end() + MARGIN <= covered:
            continue
        at = max(0, m.start() - MARGIN, (starts[-1] + STRIDE) if starts and covered > m.start() - MARGIN else 0)
        while True:
            starts.append(at)
            covered = at + WINDOW
            if covered >= min(m.end() + MARGIN, len(text)):
                break
            at += STRIDE
    return starts


def window_array(text: str, starts: list[int]) -> np.ndarray:
    """Windows x steps of classes, 0 behind the end of the text."""
    codes = np.concatenate([classes(text), np.zeros(WINDOW, np.int64)])
    return codes[np.asarray(starts)[:, None] + np.arange(WINDOW)]


def tag_array(spans: list[tuple[int, int, int]], length: int) -> np.ndarray:
    tags = np.zeros(length + WINDOW, np.int64)
    for kind, a, b in spans:
        tags[a], tags[a + 1:b] = 1 + 2 * kind, 2 + 2 * kind
    return tags


def plausible(kind: int, found: str) -> bool:
    """The least that a span of a kind holds."""
    digits = len(_digits(found))
    return (("@" in found and "." in found, _IP.fullmatch(found) is not None and max(map(int, re.split(r"\.", found[:60]))) <= 255, 13 <= digits <= 19 and _luhn(_digits(found)),
             9 <= digits <= 15 and len(found) <= 24)[kind] and found == found.strip())


def read_spans(tags: np.ndarray, posterior: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    at = 0
    while at < len(tags):
        if tags[at] == 0:
            at += 1
            continue
        kind, end = (tags[at] - 1) // 2, at + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        yield int(kind), at, end, float(posterior[at:end].mean())
        at = end


def reconcile(text: str, starts: list[int], tags: np.ndarray, posterior: np.ndarray, base: list) -> list[tuple[int, int, int]]:
    """Spans that the model adds: one tag per position over all windows, base spans left alone, unsure ones dropped."""
    centre = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    added, group = [], []

    def flush():
        low, high = starts[group[0]], min(starts[group[-1]] + WINDOW, len(text))
        best, tag, sure = np.full(high - low, -1), np.zeros(high - low, np.int64), np.zeros(high - low)
        for w in group:
            size = min(WINDOW, high - starts[w])
            part = slice(starts[w] - low, starts[w] - low + size)
            better = centre[:size] > best[part]
            for to, value in ((best, centre), (tag, tags[w]), (sure, posterior[w])):
                to[part][better] = value[:size][better]
        for kind, a, b, p in read_spans(tag, sure):
            a, b = a + low, b + low
            if p >= SURE and plausible(kind, text[a:b]) and not any(a < y and x < b for _, x, y in base + added):
                added.append((kind, a, b))

    for w in range(len(starts)):
        if group and starts[w] > starts[group[-1]] + WINDOW:
            flush()
            group = []
        group.append(w)
    if group:
        flush()
    return added


def _variants(text: str, spans: list, rng: np.random.Generator) -> tuple[str, list]:
    """A labelled window with other digits, and telephone numbers as they stand without their country code."""
    out, moved, end = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        found = text[a:b]
        if kind == 3:
            found = re.sub(r"^\+[0-9]+[\x20.-]*", "", found) if rng.random() < 0.6 else found
            found = re.sub("[0-9]", lambda _: str(rng.integers(10)), found)
        out += [text[end:a], found]
        start = sum(map(len, out)) - len(found)
        moved.append((kind, start, start + len(found)))
        end = b
    return "".join([*out, text[end:]]), moved


def training_windows(documents: DataFrame, rows: int = TRAIN_CANDIDATES) -> list[tuple[str, list]]:
    """(text, labelled spans) of at most `rows` windows, chosen by hash over all documents with a digit or an at sign."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = [], []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                last = -1
                for m in _TRIGGER.finditer(text):
                    if m.start() < last:
                        continue
                    low = max(0, m.start() - MARGIN)
                    last = low + WINDOW
                    inside = [(k, a - low, b - low) for k, a, b in base if low <= a and b <= last]
                    if not any(a < last and low < b and not (low <= a and b <= last) for _, a, b in base):
                        texts.append(text[low:last])
                        labels.append(";".join(f"{k} {a} {b}" for k, a, b in inside))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.string())], names=["part", "spans"])

    cuts = documents.select("text").where(F.col("text").rlike("[0-9@]")).mapInArrow(cut, "part string, spans string")
    chosen = sampled(cuts.withColumn("held", F.col("spans") != ""), rows // 2, "part", "spans", within=("held",))
    return [(r["part"], [tuple(map(int, s.split())) for s in r["spans"].split(";") if s]) for r in chosen.collect()]


def train(documents: DataFrame) -> Tagger:
    """A tagger fitted on a bounded sample of windows; where no text has a digit or an at sign it adds nothing."""
    found = training_windows(documents)
    rng = np.random.default_rng(5)
    found.sort()
    found = [found[k] for k in rng.permutation(len(found))]
    held, free = [w for w in found if w[1]], [w for w in found if not w[1]]
    picked = held[:TRAIN_WINDOWS // 3] + free[:TRAIN_WINDOWS // 3]
    picked += [_variants(*w, rng) for w in held[:TRAIN_WINDOWS // 3]]
    tagger = Tagger()
    if picked:
        x = np.zeros((len(picked), WINDOW), np.int64)
        y = np.zeros((len(picked), WINDOW), np.int64)
        for k, (text, spans) in enumerate(picked):
            text = text[:WINDOW]
            shift = int(rng.integers(0, WINDOW - len(text) + 1))
            x[k, shift:shift + len(text)] = classes(text)
            y[k] = tag_array([(a, b + shift, c + shift) for a, b, c in spans if c <= len(text)], WINDOW)[:WINDOW]
        tagger.fit(x, y)
    return tagger


def find(texts: list[str], tagger: Tagger, at_once: int = 1024) -> Iterator[tuple[list, list]]:
    """(base spans, added spans) of every text; windows of many texts are decoded together, bounded in number."""
    held: list[tuple] = []
    windows = 0

    def decoded():
        arrays = [window_array(t, s) for t, _, s in held if s]
        every = np.concatenate(arrays) if arrays else np.zeros((0, WINDOW), np.int64)
        parts = [tagger.decode(every[k:k + at_once]) for k in range(0, len(every), at_once)]
        tags = np.concatenate([p[0] for p in parts]) if parts else every
        sure = np.concatenate([p[1] for p in parts]) if parts else every
        k = 0
        for text, base, starts in held:
            part = slice(k, k + len(starts))
            yield base, reconcile(text, starts, tags[part], sure[part], base) if starts else []
            k += len(starts)

    for text in texts:
        starts = window_starts(text)
        held.append((text, base_spans(text), starts))
        windows += len(starts)
        if windows >= at_once:
            yield from decoded()
            held, windows = [], 0
    yield from decoded()


def find_personal_data(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row.

    Null texts count as empty; repeated rows are each returned; a null doc_id stays null; an empty table gives no
    rows; columns other than doc_id and text are ignored.  Overlaps between kinds stay among base spans; the model's
    spans never touch a base span.
    """
    tagger = tagger or train(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, added in find(batch.column(1).to_pylist(), tagger):
                kinds = [k for k, _, _ in base]
                rows.append((*map(kinds.count, range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union goes."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= end:
            continue
        out += [text[end:max(a, end)], f"[{KINDS[kind].upper()}]" if a >= end else ""]
        end = b
    return "".join([*out, text[end:]])


def redact_documents(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """The same rows and columns with personal data in `text` replaced by [EMAIL], [IP], [CARD] or [PHONE].

    Null texts stay null, empty ones empty.  An integer column n_chars, where there is one, gets the new length; it stays
    null if null.  Repeated rows are each returned, with the same new text; spans that overlap are replaced as one, by the
    kind of the first; an empty table gives no rows; other columns stay as they are.
    """
    tagger = tagger or train(documents)
    place = documents.columns.index("text")
    numbered = documents.toDF(*(f"c{k}" for k in range(len(documents.columns))))  # by place: names may hold anything
    fields = numbered.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            there = [t for t in texts if t is not None]
            clean = iter([redact(t, base + added) for t, (base, added) in zip(there, find(there, tagger), strict=True)])
            new = [None if t is None else next(clean) for t in texts]
            columns = list(batch.columns)
            columns[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    cleaned = numbered.mapInArrow(run, numbered.schema).toDF(*documents.columns)
    if dict(documents.dtypes).get("n_chars") in ("bigint", "int"):
        length = F.length("text").cast(documents.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))
    return cleaned
