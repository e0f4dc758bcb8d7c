"""Secret scan: fixed patterns, and a character convolutional network over every other candidate."""

from __future__ import annotations

import functools
import hashlib
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import DOCUMENT_COLUMNS, columns_of, read_table
from cardwatch.llm.registry import query

# The base patterns and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a shorter run has no match at any of its places
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
KEYED = re.compile(r"[:=]\x20*[\"']?$")
LEFT, RUN, RIGHT = 32, 56, 12  # characters that the network sees at once; longer runs take more views
STEP = RUN - 16  # from one view of a long run to the next
WIDTH, FILTERS = 5, 24
SYMBOLS = {c: i + 2 for i, c in enumerate(string.printable)}  # 0 is padding, 1 any other character
CODES = len(SYMBOLS) + 2
SEGMENTS = ((0, LEFT), (LEFT, LEFT + RUN), (LEFT + RUN, LEFT + RUN + RIGHT))
FINDINGS = 12_000  # labelled findings that are generated; a quarter calibrates
EPOCHS = 12
LEAST_RECALL = 0.98
VIEWS_AT_ONCE = 4096
REDACTED = "[REDACTED]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, leftmost and non-overlapping within a kind; matches
    that are too short are dropped but use up their characters."""
    spans = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                spans.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                spans.append((m.start(), 1, m.end()))
    spans.extend((m.start(), 2, m.end()) for m in HEX.finditer(text))
    return sorted(spans)


def other_candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of key characters with a letter that base spans do not cover: a run counts as a whole
    where a letter or digit of it is left on either side of them."""
    out = []
    covered = _joined_intervals(taken)
    k = 0
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if not any(c.isalpha() for c in m.group()):
            continue
        while k < len(covered) and covered[k][1] <= s:
            k += 1
        left, at, j = "", s, k
        while j < len(covered) and covered[j][0] < e:
            left += text[at : max(at, covered[j][0])]
            at = covered[j][1]
            j += 1
        left += text[at:e]
        if any(c.isalnum() for c in left):
            out.append((s, e))
    return out


def _joined_intervals(taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for s, _, e in taken):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def encode(text: str, start: int, end: int, at: int | None = None) -> list[int]:
    """Codes of the left context, the candidate from ``at`` on and the right context, padded."""
    at = start if at is None else at
    middle = text[at : min(end, at + RUN)]
    left = text[max(0, start - LEFT) : start]
    right = text[end : end + RIGHT]
    code = SYMBOLS.get
    return (
        [0] * (LEFT - len(left))
        + [code(c, 1) for c in left]
        + [code(c, 1) for c in middle]
        + [0] * (RUN - len(middle))
        + [code(c, 1) for c in right]
        + [0] * (RIGHT - len(right))
    )


def views(start: int, end: int) -> list[int]:
    """Where the overlapping views of a candidate begin; together they cover all of it. A candidate
    scores as its best view, which pools over its whole length."""
    if end - start <= RUN:
        return [start]
    return [*range(start, end - RUN, STEP), end - RUN]


@dataclass
class Network:
    """Convolution over characters, the largest value per filter and segment, a logistic unit."""

    table: np.ndarray  # WIDTH x CODES x FILTERS: the convolution as a look-up per place
    bias: np.ndarray
    out: np.ndarray  # one weight per segment and filter, and the constant
    slope: float = 1.0  # calibration of the logit
    shift: float = 0.0
    thresholds: tuple[float, float] = (0.5, 0.5)  # bare and keyed candidates

    def _pool(self, x: np.ndarray):
        padded = np.pad(x, ((0, 0), (0, WIDTH - 1)))
        maps = self.bias + sum(self.table[k][padded[:, k : k + x.shape[1]]] for k in range(WIDTH))
        at = np.stack([maps[:, a:b].argmax(axis=1) + a for a, b in SEGMENTS], axis=1)
        top = np.take_along_axis(maps, at, axis=1)
        return padded, at, np.maximum(top, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        _, _, top = self._pool(x)
        return top.reshape(len(x), -1) @ self.out[:-1] + self.out[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.logits(x[i : i + 512]) for i in range(0, len(x), 512)])
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, keyed: np.ndarray, seed: int = 3) -> Network:
    """Three quarters fit the network by stochastic gradients. The rest calibrates its logit
    (a logistic fit) and sets, for bare and for keyed candidates, the highest threshold that still
    finds ``LEAST_RECALL`` of the true findings with a digit and of those without."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (WIDTH, CODES, FILTERS)),
        np.zeros(FILTERS),
        rng.normal(0, 0.1, len(SEGMENTS) * FILTERS + 1),
    )
    order = rng.permutation(len(x))
    fit, check = order[len(x) // 4 :], order[: len(x) // 4]
    rate = 0.5
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
            padded, at, top = net._pool(x[part])
            flat = top.reshape(len(part), -1)
            p = 1 / (1 + np.exp(-np.clip(flat @ net.out[:-1] + net.out[-1], -30, 30)))
            e = (p - y[part]) / len(part)
            back = (e[:, None] * net.out[:-1]).reshape(top.shape) * (top > 0)
            net.out -= rate * np.append(e @ flat, e.sum())
            net.bias -= rate * back.sum(axis=(0, 1))
            filters = np.broadcast_to(np.arange(FILTERS), at.shape)
            for k in range(WIDTH):
                codes = padded[np.arange(len(part))[:, None, None], at + k]
                gradient = np.bincount(
                    (codes * FILTERS + filters).ravel(), weights=back.ravel(), minlength=CODES * FILTERS
                )
                net.table[k] -= rate * gradient.reshape(CODES, FILTERS)
        rate *= 0.85
    z = net.logits(x[check])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -30, 30)))
        net.slope -= 0.1 * float(np.mean((p - y[check]) * z))
        net.shift -= 0.1 * float(np.mean(p - y[check]))
    p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -30, 30)))
    digit = np.isin(x[check, LEFT : LEFT + RUN], [SYMBOLS[c] for c in string.digits]).any(axis=1)
    limits = []
    for kind in (0, 1):
        groups = [(y[check] == 1) & (keyed[check] == kind) & (digit == some) for some in (0, 1)]
        found = [np.sort(p[g]) for g in groups if g.any()]
        limits.append(min((float(f[int((1 - LEAST_RECALL) * len(f))]) for f in found), default=0.5))
    net.thresholds = (limits[0], limits[1])
    return net


def labelled_findings(n: int = FINDINGS, seed: int = 11):
    """Findings with their label, generated because no table of them is given: keys of common forms
    in prose or after a key name (1), and runs that look alike but are none (0): numbered words,
    dates, paths, identifiers, order numbers, long plain words, rules and words run together.
    Keys of letters alone are among the true ones."""
    rng = np.random.default_rng(seed)
    letters, digits = string.ascii_lowercase, string.digits
    alnum = string.ascii_letters + digits

    def some(chars, low, high):
        return "".join(rng.choice(list(chars), rng.integers(low, high + 1)))

    def words(k):
        return " ".join(some(letters, 2, 9) for _ in range(k))

    def joined(k, mark):
        return mark.join(some(letters, 3, 9) for _ in range(k))

    def spoken(k):
        return "".join(some("bcdfghklmnprstvwz", 1, 1) + some("aeiou", 1, 1) + some("lnrst", 0, 1) for _ in range(k))

    secrets = (
        lambda: "ghp_" + some(alnum, 36, 36),
        lambda: "sk_live_" + some(alnum, 24, 32),
        lambda: "xoxb-" + some(digits, 11, 12) + "-" + some(alnum, 24, 24),
        lambda: "eyJ" + some(alnum, 30, 60),
        lambda: some(alnum + "+/", 40, 64) + "=",
        lambda: some(alnum, 20, 44),
        lambda: some(alnum + "_-", 22, 48),
        lambda: some(string.ascii_uppercase + digits, 20, 32),
        lambda: some(string.ascii_letters, 20, 44),
    )
    harmless = (
        lambda: joined(3, "_") + some(digits, 1, 3),
        lambda: joined(3, "-") + "-" + some(digits, 1, 4),
        lambda: joined(3, "/") + "/" + some(digits, 2, 4),
        lambda: some(letters, 15, 26) + some(digits, 1, 2),
        lambda: "2024-" + some(digits, 2, 2) + "-" + some(digits, 2, 2) + "T" + some(digits, 6, 6) + "Z",
        lambda: "order-" + some(digits, 10, 14),
        lambda: some(letters, 4, 8).capitalize() + "-" + some(letters, 6, 12) + some(digits, 2, 4),
        lambda: "+".join(some(letters, 3, 7) for _ in range(3)) + some(digits, 1, 2),
        lambda: spoken(8),
        lambda: spoken(8).capitalize(),
        lambda: spoken(8).upper(),
        lambda: joined(int(rng.integers(3, 9)), ("_", "-", "/", "~", "=")[rng.integers(5)]),
        lambda: "".join(spoken(int(rng.integers(2, 4))).capitalize() for _ in range(int(rng.integers(4, 7)))),
        lambda: some("x", 1, 1) + "-=_~"[rng.integers(4)] * int(rng.integers(16, 60)),
    )
    names = ("key", "auth", "credential", "bearer", "pwd", "client", "access")
    x, y, keyed = [], [], []
    for i in range(n):
        label = int(rng.random() < 0.5)
        forms = secrets if label else harmless
        run = forms[rng.integers(len(forms))]()
        with_key = rng.random() < (0.5 if label else 0.25)
        left = words(int(rng.integers(0, 8)))
        if with_key:
            name = names[rng.integers(len(names))] if label else some(letters, 3, 8)
            left += " " + name + ("=", ": ", ' = "', ":'")[rng.integers(4)]
        else:
            left += (" ", "\n", " (")[rng.integers(3)]
        right = (" ", '" ', ". ", "\n", ", ")[rng.integers(5)] + words(3)
        text = left + run + right
        x.append(encode(text, len(left), len(left) + len(run)))
        y.append(label)
        keyed.append(int(with_key))
    return np.array(x, np.int16), np.array(y, float), np.array(keyed)


def all_spans(texts: list[str | None], net: Network) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of every text; null is taken as empty. The network scores the candidates
    of all texts at once; a candidate counts from the threshold of its kind on."""
    spans = [base_spans(t) if t else [] for t in texts]
    where, x, keyed, hits = [], [], [], set()

    def flush():
        if x:
            found = net.scores(np.array(x, np.int16)) >= np.array(net.thresholds)[keyed]
            hits.update(w for w, hit in zip(where, found) if hit)
            for part in (where, x, keyed):
                part.clear()

    for i, t in enumerate(texts):
        for s, e in other_candidates(t, spans[i]) if t else ():
            kind = 1 if KEYED.search(t[max(0, s - 8) : s]) else 0
            for at in views(s, e):
                where.append((i, s, e))
                x.append(encode(t, s, e, at))
                keyed.append(kind)
                if len(x) >= VIEWS_AT_ONCE:
                    flush()
    flush()
    if hits:
        for i, s, e in hits:
            spans[i].append((s, 3, e))
        for found_in in spans:
            found_in.sort()
    return spans


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span, or run of overlapping spans, gives way to a fixed mark."""
    out, done, end = [], 0, -1
    for s, _, e in spans:
        if s >= end:
            if end >= 0:
                done = end
            out += [text[done:s], REDACTED]
            end = e
        else:
            end = max(end, e)
    return "".join(out) + text[max(end, 0) :] if out else text


def scan(docs: DataFrame, net: Network, *keep: str, redacted: bool = False) -> DataFrame:
    """``keep``, the counts per kind, ``base_sha256`` and ``spans`` for each row; with ``redacted``
    the text without its secrets as ``redacted_text``. Null and empty texts have no spans; equal
    rows get equal results; an empty table gives no rows. Runs of digits alone and runs under 16
    characters are no candidates of the network."""
    data = columns_of(docs, *dict.fromkeys([*keep, "text"]))
    fields = [f for f in data.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", n_assign bigint, n_access bigint, n_hex bigint, n_model bigint, base_sha256 string, spans string"
    schema += ", redacted_text string" * redacted
    names = [f.name for f in fields] + "n_assign n_access n_hex n_model base_sha256 spans".split()
    names += ["redacted_text"] * redacted

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = all_spans(texts, net)
            columns = [batch.column(f.name) for f in fields]
            for kind in range(4):
                columns.append(pa.array([sum(k == kind for _, k, _ in s) for s in found], pa.int64()))
            base = [_joined(x for x in s if x[1] < 3) for s in found]
            columns.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()))
            columns.append(pa.array([_joined(s) for s in found], pa.string()))
            if redacted:
                columns.append(
                    pa.array([t if not s else redact(t, s) for t, s in zip(texts, found)], pa.string())
                )
            yield pa.RecordBatch.from_arrays(columns, names)

    return data.mapInArrow(run, schema)


@functools.cache
def trained() -> Network:
    return train(*labelled_findings())


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts redacted; null and empty texts stay."""
    found = scan(docs, trained(), *DOCUMENT_COLUMNS, redacted=True)
    changed = F.length("spans") > 0
    return found.select(
        "doc_id",
        F.col("redacted_text").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("redacted_text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars"))
        .alias("n_chars"),
    )


@query("op1_secret_scan")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return scan(read_table(spark, folder, "documents"), trained(), "doc_id")
