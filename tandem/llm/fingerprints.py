"""Document fingerprints: modular prefix arrays of polynomial hashes.

The fingerprint of a text is the array of the hashes of all its prefixes, for two prime moduli. From two such
arrays the equality of any two spans is one multiplication, and the longest common extension of two positions is
found by binary search over its length. ``digest`` names a fingerprint by its length and its last entries, so equal
texts have equal digests. The likeness of two fingerprints is the share of the longer text that is covered by the
longest common prefix and the longest common suffix.

Defined results: a null text counts as empty; two empty texts are alike by 1, an empty and another text by 0. The
document after the last one is the first, so a single document is followed by itself; rows with the same id follow
each other by text, and null ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm import ordered

#: Two primes below 2**31, so that products fit 64 bits, and a base for each.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(k: int, n: int) -> np.ndarray:
    """Base ``k`` to the powers 0 to n - 1; doubled whenever a longer text comes."""
    p, m = _powers[k], np.uint64(MODULI[k])
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(BASES[k], len(p), MODULI[k])) % m])
    _powers[k] = p
    return p[:n]


class Fingerprint:
    """Prefix arrays of one text; ``pre[k][i]`` is the sum of (code + 1) * base**j over j < i, modulo a prime."""

    __slots__ = ("n", "pre")

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.pre = []
        for k, m in enumerate(MODULI):
            pre = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * powers(k, self.n) % np.uint64(m), out=pre[1:])
            self.pre.append(pre % np.uint64(m))

    def digest(self) -> str:
        return f"{self.n:x}-" + "".join(f"{int(pre[-1]):08x}" for pre in self.pre)


def same_span(a: Fingerprint, i: int, b: Fingerprint, j: int, length: int) -> bool:
    """Whether ``length`` characters of a from i and of b from j are the same."""
    for k, m in enumerate(MODULI):
        x = (int(a.pre[k][i + length]) - int(a.pre[k][i])) % m
        y = (int(b.pre[k][j + length]) - int(b.pre[k][j])) % m
        # Each sum carries the power of its start; multiplying by the other's makes them comparable.
        if i != j:
            p = powers(k, max(i, j) + 1)
            x, y = x * int(p[j]) % m, y * int(p[i]) % m
        if x != y:
            return False
    return True


def common_extension(a: Fingerprint, i: int, b: Fingerprint, j: int) -> int:
    """The longest length for which both texts go on alike from i and j."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if same_span(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def common_ending(a: Fingerprint, b: Fingerprint) -> int:
    """The longest length for which both texts end alike."""
    low, high = 0, min(a.n, b.n)
    while low < high:
        middle = (low + high + 1) // 2
        if same_span(a, a.n - middle, b, b.n - middle, middle):
            low = middle
        else:
            high = middle - 1
    return low


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    longest, shortest = max(a.n, b.n), min(a.n, b.n)
    if not longest:
        return 1.0
    head = common_extension(a, 0, b, 0)
    return (head + min(common_ending(a, b), shortest - head)) / longest


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by as many first characters of the next, or all of them."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows of one bucket, its lent rows last; only the row before and its fingerprint are held."""
    before: tuple[int | None, str, Fingerprint] | None = None
    closed = False
    for batch in batches:
        out = []
        for has_id, doc_id, text, lent in zip(batch["has_id"], batch["id"], batch["text"], batch[ordered.LENT], strict=True):
            if closed:
                break
            now = Fingerprint(text)
            if before is not None:
                key, own, print_ = before
                changed = edited(own, text)
                other = Fingerprint(changed)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((key, print_.n, digest, print_.digest(), other.digest(), likeness(print_, other), likeness(print_, now)))
            before = (doc_id if has_id else None, text, now)
            closed = bool(lent)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in COMPARED.split(",")]).astype({"doc_id": "Int64"})


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document by id."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = ordered.key_bounds(rows, "id", ordered.bucket_count(rows))
    dealt = ordered.deal_with_next(rows, "id", bounds, "text")
    dealt = dealt.select(F.col("id").isNotNull().alias("has_id"), F.coalesce("id", F.lit(0)).alias("id"), "text", ordered.LENT)
    return dealt.mapInPandas(_compared, COMPARED)
