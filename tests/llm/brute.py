"""Plain versions of what the operators compute."""

import hashlib
from collections import Counter

from plycask.llm.words import split_words


def covered(sequences, window):
    """For each sequence, flags of the items in a window that starts more than once."""
    counts = Counter(tuple(s[i : i + window]) if not isinstance(s, bytes) else s[i : i + window] for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        flags = [False] * len(s)
        for i in range(len(s) - window + 1):
            key = s[i : i + window] if isinstance(s, bytes) else tuple(s[i : i + window])
            if counts[key] > 1:
                flags[i : i + window] = [True] * window
        out.append(flags)
    return out


def words_kept(texts, window):
    """(words, removed, hash of what stays) of each text."""
    words = [split_words(text) for text in texts]
    kept = [[w for w, gone in zip(x, flags, strict=True) if not gone] for x, flags in zip(words, covered(words, window), strict=True)]
    return [(len(x), len(x) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for x, k in zip(words, kept, strict=True)]


def bytes_kept(texts, window):
    """(bytes, removed, spans, hash of what stays) of each text."""
    data = [(text or "").encode() for text in texts]
    out = []
    for x, flags in zip(data, covered(data, window), strict=True):
        kept = bytes(b for b, gone in zip(x, flags, strict=True) if not gone)
        spans = sum(gone and not before for gone, before in zip(flags, [False, *flags], strict=False))
        out.append((len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out
