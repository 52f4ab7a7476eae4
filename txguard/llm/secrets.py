"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests tells from words.

Patterns, leftmost and non-overlapping per kind, on the whole text: `assign` (a name such as token, a sign and
a value of 8 or more characters; the span is the whole match), `access` and `hex`. Beyond them, each run of
LEAST or more of `A-Za-z0-9+/_-` that meets no pattern's span is tested as kind `random`:

* its encoding is the smallest alphabet of ALPHABETS with all its characters;
* three statistics: chi-squared of its characters against uniform use of that alphabet, runs of equal
  character class, serial correlation of successive characters;
* each has a one-sided p-value under the hypothesis that the run is made as words are, i.e. by the chain
  of character pairs counted over all texts of the corpus, confined to that alphabet; mean and deviation for
  the encoding and length come from SIMULATED strings of that chain with fixed seeds;
* a run that differs from uniformly drawn characters by more than AWAY deviations in one of them is no secret;
* the three p-values are joined by Fisher's method. Step-up false-discovery control at level RATE is applied to all
  tested runs of the corpus, separately in each length stratum, as short runs say less.

Null and empty texts have no spans. Rows are judged one by one, so ids that repeat do not matter. A corpus without
character pairs tests nothing, and an empty table gives no rows. Long texts are taken whole. Ties of spans go by start, then kind as listed.
Only doc_id and text are read; other columns may have any name and are kept by `redacted`.
"""

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


LEAST, RATE, SIMULATED, AWAY = 20, 0.001, 400, 4
STRATA = (20, 24, 32, 48, 80)  # first length of each
MARK = "[SECRET]"

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS, _HEX = re.compile("AKIA[A-Z0-9]{12,}"), re.compile("[0-9a-f]{32,}")
_RUN = re.compile("[A-Za-z0-9+/_-]{%d,}" % LEAST)
KINDS = ("assign", "access", "hex", "random")

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "upper base36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _DIGITS + _UPPER + _LOWER + "+/",
    "base64url": _DIGITS + _UPPER + _LOWER + "-_",
    "any": _DIGITS + _UPPER + _LOWER + "+/-_",
}
_ALL = ALPHABETS["any"]
_INDEX = np.full(256, -1, dtype=np.int16)
_INDEX[np.frombuffer(_ALL.encode(), dtype=np.uint8)] = np.arange(len(_ALL))
_CLASS = np.array([0] * 10 + [1] * 26 + [2] * 26 + [3] * 4)


def base_spans(text: str, long_run: bool = True) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, by start."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if long_run:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
        found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def has_long_run(texts: list[str], least: int = 16) -> np.ndarray:
    """Which texts hold a run of `least` alphabet characters, found on bytes."""
    parts = [t.encode("utf-8", "replace") for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts])
    inside = np.concatenate([[False], _INDEX[np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)] >= 0])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    long = turns[::2][turns[1::2] - turns[::2] >= least]
    out = np.zeros(len(texts), dtype=bool)
    out[np.searchsorted(ends, long, side="right")] = True
    return out


def encoding(codes: np.ndarray) -> str:
    used = set(codes.tolist())
    return next(name for name, members in _MEMBERS.items() if used <= members)


_MEMBERS = {name: {_ALL.index(c) for c in a} for name, a in ALPHABETS.items()}


def statistics(codes: np.ndarray, name: str) -> np.ndarray:
    """Chi-squared per symbol, runs per symbol, size of the serial correlation: of one run."""
    n, size = len(codes), len(ALPHABETS[name])
    used = np.bincount(codes, minlength=len(_ALL))
    chi = (used.astype(float) ** 2).sum() * size / n - n
    kinds = _CLASS[codes] if name not in ("lower", "upper") else codes % 2
    runs = 1 + (kinds[1:] != kinds[:-1]).sum()
    place = _PLACE[name][codes]
    a, b = place[:-1] - place.mean(), place[1:] - place.mean()
    spread = ((place - place.mean()) ** 2).sum()
    return np.array([chi / size, runs / n, abs((a * b).sum() / spread) if spread else 1.0])


_PLACE = {name: np.array([a.find(c) for c in _ALL], dtype=float) for name, a in ALPHABETS.items()}
_TOWARDS = np.array([-1, 1, -1])  # random strings have less, more, less


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often each character of the alphabet follows each other, over all texts."""
    n = len(_ALL)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, dtype=np.int64)
        for batch in batches:
            for one in batch.column(0):
                codes = _INDEX[np.frombuffer((one.as_py() or "").encode("utf-8", "replace"), dtype=np.uint8)]
                a, b = codes[:-1].astype(np.int32), codes[1:].astype(np.int32)
                total += np.bincount((a * n + b)[(a >= 0) & (b >= 0)], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    found = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = found.toPandas()  # one row per pair of the alphabet at most
    total = np.zeros(n * n)
    total[found["pair"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return total.reshape(n, n)


def null_table(pairs: np.ndarray) -> dict:
    """(encoding, first length of a stratum) -> mean and deviation of the statistics of word-like strings,
    and mean and deviation of those of uniform strings."""
    table = {}
    for name, members in _MEMBERS.items():
        own = sorted(members)
        chain = pairs[np.ix_(own, own)] + 1e-6 * max(1.0, pairs.sum()) / pairs.size
        for length in STRATA:
            table[name, length] = *_simulated(chain, own, name, length), *_simulated(np.ones_like(chain), own, name, length)
    return table


def _simulated(chain: np.ndarray, own: list, name: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    start = np.cumsum(chain.sum(axis=1)) / chain.sum()
    steps = np.cumsum(chain / chain.sum(axis=1, keepdims=True), axis=1)
    draw = np.random.default_rng([len(own), length]).random((length, SIMULATED))
    state = np.minimum(np.searchsorted(start, draw[0]), len(own) - 1)
    strings = [state]
    for k in range(1, length):
        state = np.minimum((steps[state] < draw[k][:, None]).sum(axis=1), len(own) - 1)
        strings.append(state)
    values = np.array([statistics(c, name) for c in np.array(own)[np.array(strings).T]])
    return values.mean(axis=0), values.std(axis=0) + 0.01


def stratum(length: int) -> int:
    return max(s for s in STRATA if s <= length)


def log_p(codes: np.ndarray, table: dict) -> float:
    """log10 of the joint p-value: how likely a word-like string seems as random as this one; 0 if it is uneven."""
    name, first = encoding(codes), stratum(len(codes))
    mean, deviation, even, even_deviation = table[name, first]
    value = statistics(codes, name)
    longer = len(codes) / first
    if ((value - even) * -_TOWARDS > AWAY * even_deviation).any():
        return 0.0
    grown = np.array([longer, 1, 1])  # against uniform use, the chi-squared of words grows with the length
    z = _TOWARDS * (value - mean * grown) / (deviation * np.array([math.sqrt(longer), 1, 1]))
    fisher = sum(np.logaddexp(0, math.pi / math.sqrt(3) * x) for x in z)  # tails as of the logistic law
    return (math.log(1 + fisher + fisher * fisher / 2) - fisher) / math.log(10)  # chi-squared, 6 degrees


def candidates(text: str, base: list) -> list[tuple[int, int]]:
    """Runs to be tested: those that meet no span of a pattern."""
    return [
        m.span() for m in _RUN.finditer(text) if not any(m.start() < e and s < m.end() for s, _, e in base)
    ]


def _tested(text: str, base: list, table: dict) -> Iterator[tuple[int, int, int]]:
    """(start, end, hundredths of log10 p, rounded up) of each run to be tested."""
    for a, b in candidates(text, base):
        codes = _INDEX[np.frombuffer(text[a:b].encode(), dtype=np.uint8)]
        yield a, b, math.ceil(100 * max(log_p(codes, table), -300.0))


def _read(texts: list) -> Iterator[tuple[str, bool]]:
    for a in range(0, len(texts), 200):
        part = [x or "" for x in texts[a : a + 200]]
        yield from zip(part, has_long_run(part).tolist())


def thresholds(docs: DataFrame, table: dict) -> dict[int, int]:
    """Stratum -> largest p-value (hundredths of log10) that counts as found."""
    held = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for one, long in _read(batch.column(0).to_pylist()):
                for a, b, p in _tested(one, base_spans(one), held.value) if long else ():
                    key = (stratum(b - a), p)
                    total[key] = total.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
             pa.array(list(total.values()), pa.int64())], ["stratum", "p", "n"])

    found = docs.select("text").mapInArrow(count, "stratum int, p int, n long")
    found = found.groupBy("stratum", "p").agg(F.sum("n").alias("n")).toPandas()  # 30,001 values of p at most
    out = {}
    for first in STRATA:
        own = found[found["stratum"] == first].sort_values("p")
        rank = own["n"].cumsum()
        passed = own["p"][own["p"] / 100 <= np.log10(RATE * rank / max(1, own["n"].sum()))]
        out[first] = int(passed.max()) if len(passed) else -100_000
    return out


def all_spans(text: str, long_run: bool, table: dict, limit: dict) -> list[tuple[int, str, int]]:
    base = base_spans(text, long_run)
    more = [
        (a, "random", b) for a, b, p in (_tested(text, base, table) if long_run else ()) if p <= limit[stratum(b - a)]
    ]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1])))


def _fitted(docs: DataFrame):
    table = null_table(pair_counts(docs))
    return docs.sparkSession.sparkContext.broadcast((table, thresholds(docs, table)))


def shown(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, n_random, spans of each row of `docs` (doc_id, text)."""
    held = _fitted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(x, long, *held.value) for x, long in _read(batch.column(1).to_pylist())]
            count = [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in KINDS]
            base = [shown([s for s in f if s[1] != "random"]) for f in found]
            digest = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *count[:3], digest, count[3], pa.array([shown(f) for f in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_random", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, n_random long, spans string"
    )


def without(text: str, spans: list) -> str:
    """The text with each stretch of spans replaced by MARK."""
    out, end = [], 0
    for a, _, b in spans:
        if a >= end:
            out += [text[end:a], MARK]
        end = max(end, b)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame) -> DataFrame:
    """`docs`, all rows and columns, with secrets replaced in text and n_chars (if there) counted again."""
    held = _fitted(docs)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            clean = [
                x if x is None else without(x, all_spans(x, long, *held.value))
                for x, (_, long) in zip(texts, _read(texts))
            ]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(clean, batch.schema.field("text").type)
            if "n_chars" in names:
                at = names.index("n_chars")
                kept = columns[at].to_pylist()
                sizes = [k if a == b else len(b) for a, b, k in zip(texts, clean, kept)]
                columns[at] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)
