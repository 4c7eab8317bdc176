"""What several operators take from a text: the white space and case rules of their contracts."""

from __future__ import annotations

import numpy as np
import xxhash

#: White space is \x20 and \x09 to \x0D, nothing else.
WHITE = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)


def line_key(line: str) -> bytes:
    """Stripped at both ends, A-Z lower-cased (bytes.lower changes ASCII letters only)."""
    return line.strip(WHITE).encode("utf-8", "surrogatepass").lower()


def words_of(text: str) -> list[bytes]:
    """Maximal runs without white space; bytes.split takes exactly the six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def key_arrays(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)
