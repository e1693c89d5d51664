"""Secret scans: three written patterns, and strings whose characters are too evenly spread to be words.

The added method slides a window over candidate strings (long runs of characters that keys are made of) and keeps,
by adding one character and taking one away, the counts of every character and of every class (lower case, upper
case, digit, other). The Shannon entropy of a window is that of its classes plus the weighted entropies within the
classes, all read from those counts. Each set of classes has limits of its own: all three; both cases with few or no
digits; one case with digits (base 32, hex, lower case with digits), the last in runs without separators. Letters of
one case alone and digits alone are not told from words and numbers. Neighbouring windows over the limits grow into one
span; less than a window of a run without separators is not left over. The allow-list drops windows near a placeholder, and runs that are identifiers as a whole; what lies in a
written pattern is left out.

Defined results: a null or empty text has no spans; every row is scanned for itself, so repeated rows repeat.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from math import log2
from operator import ne

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

_NAME = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = re.compile(rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A run is taken whole either way, so asking for its least length in the pattern drops the same matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Settings of the entropy scan: characters in a window, bits over all its characters, and bits within the letters
#: and digits of the classes it must mix.
WINDOW = 20
MIN_BITS = 3.6
MIN_DIGITS = 2
MIN_CLASSES = 3
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: Both cases with fewer digits than ``MIN_DIGITS``: characters of each case; words joined by capitals have fewer capitals.
MIN_EACH_CASE = 7
LETTERS = re.compile(rf"[A-Za-z]{{{WINDOW},}}")
#: One case and digits: bits, bits where all are hex digits, and changes between letters and digits.
ONE_CASE = (re.compile(rf"[a-z0-9]{{{WINDOW},}}"), re.compile(rf"[A-Z0-9]{{{WINDOW},}}"))
MIN_ONE_CASE_BITS = 3.3
MIN_HEX_BITS = 2.9
MIN_CHANGES = 3
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
#: Strings that look random but are none: placeholders, alphabets, identifiers written with separators.
PLACEHOLDERS = (
    re.compile(r"(?i)example|placeholder|changeme|dummy|sample|redacted|x{6,}|\*{4,}"),
    re.compile(r"(?i)abcdefgh|12345678|qwertyui"),
)
IDENTIFIERS = (
    re.compile(r"^([A-Z]?[a-z]+|[A-Z]+)([_/-]([A-Z]?[a-z]+|[A-Z]+))+$"),
    re.compile(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
)
#: A placeholder allows the windows that begin or end less than so many characters from it.
NEAR = WINDOW

Span = tuple[str, int, int]


def _class_of(ch: str) -> int:
    return 0 if "a" <= ch <= "z" else 1 if "A" <= ch <= "Z" else 2 if "0" <= ch <= "9" else 3


_C_LOG_C = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def _windows(text: str, window: int) -> Iterator[tuple[int, list[int], float]]:
    """The start of each window, its characters by class, and its bits."""
    counts: dict[str, int] = {}
    size = [0, 0, 0, 0]
    inner = [0.0, 0.0, 0.0, 0.0]  # by class: the sum of c * log2(c) over its characters
    clog = _C_LOG_C if window == WINDOW else [0.0] + [c * log2(c) for c in range(1, window + 1)]
    for i, ch in enumerate(text):
        k, c = _class_of(ch), counts.get(ch, 0)
        counts[ch] = c + 1
        size[k] += 1
        inner[k] += clog[c + 1] - clog[c]
        if i >= window:
            old = text[i - window]
            k, c = _class_of(old), counts[old]
            counts[old] = c - 1
            size[k] -= 1
            inner[k] += clog[c - 1] - clog[c]
        if i < window - 1:
            continue
        # Entropy of the classes, plus that inside each class by its weight: log2(n) - sum(c log2 c) / n in all.
        of_classes = log2(window) - sum(clog[n] for n in size) / window
        within = sum(n / window * (log2(n) - inner[j] / n) for j, n in enumerate(size) if n)
        yield i - window + 1, size, of_classes + within


def _joined(parts: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts that touch as one."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(parts):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def _mixed(size: list[int], bits: float) -> bool:
    return sum(n > 0 for n in size[:3]) >= MIN_CLASSES and size[2] >= MIN_DIGITS and bits >= MIN_BITS


def random_parts(text: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """[start, end) of the parts of a candidate string whose windows are mixed and evenly spread enough."""
    return _joined((at, at + window) for at, size, bits in _windows(text, window) if _mixed(size, bits))


def _one_case(run: str) -> Iterator[int]:
    """Starts of the windows over the limits of one case and digits."""
    digit = [ch.isdigit() for ch in run]
    for at, _, bits in _windows(run, WINDOW):
        part = digit[at : at + WINDOW]
        least = MIN_HEX_BITS if _HEX_DIGITS.issuperset(run[at : at + WINDOW]) else MIN_ONE_CASE_BITS
        if bits >= least and sum(map(ne, part, part[1:])) >= MIN_CHANGES:
            yield at


def _filled(starts: list[int], length: int) -> Iterator[int]:
    """Starts in a run, and those between them and up to its ends where less than a window would be left over."""
    last = length - WINDOW
    for at, then in zip([-WINDOW, *starts], [*starts, length], strict=True):
        if at >= 0:
            yield at
        if then - at < 2 * WINDOW:
            yield from range(max(at + 1, 0), min(then, last + 1))


def entropy_parts(text: str) -> list[tuple[int, int]]:
    """[start, end) of the parts of a candidate string that pass the limits of any set of classes and are not allowed."""
    starts = {
        at
        for at, size, bits in _windows(text, WINDOW)
        if _mixed(size, bits) or (size[2] < MIN_DIGITS and min(size[:2]) >= MIN_EACH_CASE and bits >= MIN_BITS)
    }
    for pattern in (*ONE_CASE, LETTERS):
        for m in pattern.finditer(text):
            n = len(m[0])
            own = [at for at in range(n - WINDOW + 1) if m.start() + at in starts] if pattern is LETTERS else list(_one_case(m[0]))
            if own:
                starts.update(m.start() + at for at in _filled(own, n))
    if not starts or any(a.search(text) for a in IDENTIFIERS):
        return []
    near = _joined((m.start() - NEAR, m.end() + NEAR) for a in PLACEHOLDERS for m in a.finditer(text))
    ends = [b for _, b in near]

    def allowed(at: int) -> bool:
        i = bisect_right(ends, at)
        return i < len(near) and near[i][0] < at + WINDOW

    return _joined((at, at + WINDOW) for at in starts if not allowed(at))


def base_spans(text: str) -> list[Span]:
    """Matches of the three written patterns, each kind leftmost and not overlapping, by start and kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def all_spans(text: str) -> list[Span]:
    """The base spans and those of the entropy scan that touch none of them."""
    base = base_spans(text)
    added: list[Span] = []
    for m in CANDIDATE.finditer(text):
        for start, end in entropy_parts(m[0]):
            start, end = m.start() + start, m.start() + end
            if not any(start < e and s < end for _, s, e in base):
                added.append(("entropy", start, end))
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[Span], mark: str) -> str:
    """The text with every span replaced; spans that overlap become one mark."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


REPORT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _reports(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        out = []
        for text in texts:
            spans = all_spans(text or "")
            base = [s for s in spans if s[0] != "entropy"]
            kinds = [s[0] for s in base]
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            out.append((*map(kinds.count, KINDS[:3]), digest, listed(spans)))
        yield pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with counts of the written kinds, a digest of their spans, and all spans."""
    own = "_secret_report"
    return docs.select(*keep, F.pandas_udf(_reports, REPORT)(text).alias(own)).select(*keep, f"{own}.*")


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns; secrets in the text are replaced by ``mark`` and its length is counted again.

    A null text stays null and keeps its length; the length is written only where the column exists.
    """

    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else redact(t, all_spans(t), mark) for t in texts], dtype=object)

    out = docs.withColumn(text, F.pandas_udf(cleaned, "string")(text))
    if length not in docs.columns:
        return out
    kind = docs.schema[length].dataType
    return out.withColumn(length, F.coalesce(F.length(text).cast(kind), F.col(length)))
