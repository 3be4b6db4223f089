"""Token ids of whole texts, with a cache of parts that recur.

A text is cut into parts whose ids do not depend on what stands around them,
each distinct part of a slice is encoded once, and the ids of the texts are put
together with numpy. Vocabulary files are read by the driver and broadcast
(1 to 2 MB), so executors need no copy of them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Callable

import numpy as np

from tarmac.llm import text as tx

CACHED_PARTS = 1 << 18
CACHED_IDS = 1 << 22     # ids of the cached parts together: 16 MB
TOGETHER = 4096  # plain parts encoded in one call
LONG_PART = 20_000
# The characters of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACED = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


class PartCache:
    """Ids of parts by the parts' hash, as flat arrays; emptied when full."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]) -> None:
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of the spans, and the number of ids of each."""
        keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHED_PARTS or len(self.ids) > CACHED_IDS:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = at[~known]
        if len(new):
            raw = data.tobytes()
            lists = self.encode([raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
            size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            flat = np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(size.sum()))
            merged = np.concatenate((self.keys, keys[~known]))
            order = np.argsort(merged)
            self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(size) - size))[order]
            self.size = np.concatenate((self.size, size))[order]
            self.ids = np.concatenate((self.ids, flat))
            self.keys = merged[order]
            place = np.searchsorted(self.keys, keys)
        size = self.size[place][inverse]
        return self.ids[tx.ragged(self.start[place][inverse], size)], size


def _once(kind: str, content: bytes, make: Callable[[], object]):
    """One object per worker process and content."""
    cache = tx.worker_cache()
    key = f"{kind}:{hashlib.sha256(content).hexdigest()}"
    if key not in cache:
        cache[key] = make()
    return cache[key]


_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def word_cache(content: bytes) -> PartCache:
    """Words or plain parts of them by the file of a tokenizer that drops white
    space, folds case and splits letters, single digits and the rest apart."""
    def make() -> PartCache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        full = Tokenizer.from_str(content.decode())
        full.encode_special_tokens = True  # their strings in a text are ordinary text
        full.no_truncation()
        full.no_padding()
        # for plain parts, which its normalizer and splitter would leave as they are
        setup = json.loads(content)
        setup |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": setup["pre_tokenizer"]["pretokenizers"][-1]}
        merges = Tokenizer.from_str(json.dumps(setup))

        def encode(parts: list[bytes]) -> list[list[int]]:
            out: list[list[int]] = [[]] * len(parts)
            plain = [i for i, p in enumerate(parts) if _PLAIN.fullmatch(p)]
            for at in range(0, len(plain), TOGETHER):
                some = plain[at : at + TOGETHER]
                x = merges.encode([parts[i].decode().lower() for i in some], is_pretokenized=True, add_special_tokens=False)
                ids = x.ids
                ends = np.searchsorted(np.array(x.word_ids), np.arange(len(some) + 1)).tolist()
                for k, i in enumerate(some):
                    out[i] = ids[ends[k] : ends[k + 1]]
            known = set(plain)
            other = [i for i in range(len(parts)) if i not in known]
            for i, x in zip(other, full.encode_batch_fast([parts[i].decode("utf-8", "replace") for i in other], add_special_tokens=False)):
                out[i] = x.ids
            return out

        return PartCache(encode)

    return _once("words", content, make)


# Bytes by kind: 0 white space, 1 letter, 2 digit, 3 other ASCII, 4 not plain
# (apostrophes begin contractions; control characters; characters beyond
# ASCII, of which the Latin-1 letters become 1 below).
_KIND = np.full(256, 4, dtype=np.uint8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[97:123] = 1
_KIND[65:91] = 1
_KIND[tx.SPACE] = 0
_KIND[39] = 4


def plain_parts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of words that a tokenizer which splits
    letters, single digits and other characters encodes apart. A word with a
    byte that is not plain stays whole."""
    if not len(data):
        return start, end
    kind = _KIND[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    after = data[at + 1]
    at = at[(after >= 0x80) & (after < 0xC0) & (after != 0x97) & (after != 0xB7)]  # but for the signs of times and division
    kind[at] = kind[at + 1] = 1
    odd = np.concatenate(([0], np.cumsum(kind == 4)))
    whole = odd[end] > odd[start]
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[start[~whole]] += 1
    step[end[~whole]] -= 1
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    cut &= np.cumsum(step, dtype=np.int8)[:-1] > 0
    cut[start] = True
    begin = np.flatnonzero(cut)
    stop = np.append(begin[1:], len(data))
    word = np.searchsorted(start, begin, side="right") - 1
    return begin, np.minimum(stop, end[word])


def ranks_of(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


def rank_cache(content: bytes, pattern: str) -> PartCache:
    """Parts by a rank file and the pattern that splits before merging."""
    def make() -> PartCache:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(content), special_tokens={})

        def encode(part: bytes) -> list[int]:
            text = part.decode("utf-8", "replace")
            if len(text) < LONG_PART:
                return encoding.encode_ordinary(text)
            ids = []
            for x in _SPACED.findall(text):
                run = len(x) - len(x.lstrip(WHITE_SPACE))
                if run < LONG_PART:
                    ids += encoding.encode_ordinary(x)
                elif run == len(x):  # one match, on which the library's pattern engine would run out of stack
                    ids += encoding._encode_single_piece(x)
                else:                # all but the last character are one match
                    ids += encoding._encode_single_piece(x[: run - 1]) + encoding.encode_ordinary(x[run - 1 :])
            return ids

        return PartCache(lambda parts: [encode(p) for p in parts])

    return _once("ranks" + pattern, content, make)


def byte_table(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids, end to end, and where each begins."""
    def make() -> tuple[np.ndarray, np.ndarray]:
        ranks = ranks_of(content)
        parts = [b""] * (max(ranks.values()) + 1)
        for k, i in ranks.items():
            parts[i] = k
        off = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return np.frombuffer(b"".join(parts), dtype=np.uint8), off

    return _once("bytes", content, make)
