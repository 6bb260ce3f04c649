"""Secret scans: fixed patterns plus character Markov models.

Base spans come from three patterns. The method adds spans of kind ``random``: strings of
20 or more token characters whose log-likelihood ratio under two first-order character
models (random strings against ordinary identifiers) is high enough. Labelled samples:
ordinary are all token strings outside base spans, random are the base spans' values and a
seeded set of generated keys; transition counts run over all documents and only the two
68 x 68 count tables reach the driver.

Spans are in code points with exclusive ends and cover a whole match. A pattern's match that is
too short is dropped but still consumes its text. A ``random`` string that touches a base
span is not added. Null text is empty; empty text has no spans; repeated rows each get a row; very long texts are
scanned whole. With no documents the models rest on the generated keys alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in order, with the least length of the match or of group 2.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the least length can stand in the pattern
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(SYMBOLS) + 1  # 0 is any other character
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, _N)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_MEAN = 0.5  # nats a character
MIN_TOTAL = 15.0  # nats


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    found = []
    low = text.lower()  # ASCII letters only ever map to ASCII letters, so no keyword is missed
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _pairs(text: str) -> np.ndarray:
    """Transition counts of the token characters of ``text``; 0 stands before and after a string."""
    code = _CODE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    code = np.r_[0, code, 0]
    both = code[:-1] * _N + code[1:]
    return np.bincount(both[both > 0], minlength=_N * _N)


def _text(x) -> str:
    return bytes(x.as_buffer()).decode("utf-8", "replace") if x.is_valid else ""


def _count(batches):
    total = np.zeros((2, _N * _N), np.int64)
    for batch in batches:
        for x in batch.column("text"):
            text = _text(x)
            at, rest = 0, []
            for start, kind, end in base_spans(text):
                value = ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]
                total[1] += _pairs(value)
                rest.append(text[at : max(at, start)])
                at = max(at, end)
            rest.append(text[at:])
            total[0] += _pairs(" ".join(rest))
    label, pair = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(total[label, pair])],
        ["label", "pair", "n"],
    )


def generated_keys(seed: int = 7, each: int = 2000) -> list[str]:
    """Labelled random strings: base64, alphanumeric, upper-case and hex keys of 20 to 64 characters."""
    rnd = random.Random(seed)
    alphabets = (SYMBOLS[:64], SYMBOLS[:62], SYMBOLS[:26] + SYMBOLS[52:62], "0123456789abcdef")
    return ["".join(rnd.choices(a, k=rnd.randint(20, 64))) for a in alphabets for _ in range(each)]


def train_counts(counts: np.ndarray) -> np.ndarray:
    """The ratio table of transition counts [label, pair] (0: ordinary, 1: random) and the generated keys."""
    p = counts.reshape(2, _N, _N) + 0.5
    p[1] += _pairs(" ".join(generated_keys())).reshape(_N, _N)
    p = np.log(p / p.sum(axis=2, keepdims=True))
    return p[1] - p[0]


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio table (random over ordinary) per character transition."""
    counts = np.zeros((2, _N * _N))
    rows = (
        docs.select(F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(_count, "label int, pair int, n long")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most 2 x 68 x 68 rows
    )
    for r in rows:
        counts[r["label"], r["pair"]] = r["n"]
    return train_counts(counts)


def random_spans(text: str, llr: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that score as random and touch none of the spans in ``taken`` (by start)."""
    found = []
    starts = [s for s, _, _ in taken]
    reach = list(accumulate((e for _, _, e in taken), max))  # the furthest end so far
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        before = bisect_left(starts, end)
        if before and reach[before - 1] > start:
            continue
        code = np.r_[0, _CODE[np.frombuffer(m.group().encode(), np.uint8)], 0]
        score = float(llr[code[:-1], code[1:]].sum())
        if score >= MIN_TOTAL and score >= MIN_MEAN * (end - start):
            found.append((start, 3, end))
    return found


def _line(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, llr: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def scan(batches):
        for batch in batches:
            counts, digests, lines = [[] for _ in KINDS], [], []
            for x in batch.column("text"):
                text = _text(x)
                base = base_spans(text)
                spans = sorted(base + random_spans(text, llr, base))
                for k, out in enumerate(counts):
                    out.append(sum(s[1] == k for s in spans))
                digests.append(hashlib.sha256(_line(base).encode()).hexdigest())
                lines.append(_line(spans))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array(digests, pa.string()), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = ids.schema["doc_id"].dataType.simpleString()
    spec = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    names = [c.split()[0] for c in spec.split(", ")]
    return ids.mapInArrow(scan, spec)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ``docs`` and scan them."""
    return scan_secrets(docs, train(docs, text_col), id_col, text_col)
