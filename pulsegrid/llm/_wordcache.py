"""Per-worker memo of a tokenizer's output for white-space-led chunks of text.

Byte-level BPE splits its input by a fixed pattern before any merge, and no
match of that pattern spans the place where a character that isn't white space
is followed by white space.  Text may therefore be cut at these places and each
chunk encoded alone; equal chunks are encoded once per worker.  A text that holds
the content of an added token is encoded whole, as the tokenizer splits it there first.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = re.compile(r"\s*\S+|\s+")
_RARE_SPACE = re.compile(r"[^\S \n]")
_ODD_SPACE = re.compile(r"\s[ \n]|[ \n]\s")
_CONTROL = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the tokenizer's pattern
_RARE_ASCII = "\t\r\x0b\x0c" + _CONTROL  # looking for each alone is faster than a pattern
TOGETHER = 1 << 18  # characters of new chunks that go to the library as one text


class CachedByteBpe:
    """``encode(text)`` gives the same ids as the tokenizers library on the whole text."""

    def __init__(self, path: str, max_entries: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        by_id = sorted((i, len(t)) for t, i in self._tokenizer.get_vocab(with_added_tokens=True).items())
        self._byte_lengths = np.zeros(by_id[-1][0] + 1, np.int64)
        self._byte_lengths[[i for i, _ in by_id]] = [n for _, n in by_id]
        self._max = max_entries // 2
        self._memo: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}  # the generation before; what is used again moves up

    def _ids(self, items: list[str]) -> list[bytes]:
        return [
            array("I", e.ids).tobytes()
            for e in self._tokenizer.encode_batch_fast(items, add_special_tokens=False)
        ]

    def _ids_of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk; those that may stand one after another are encoded as one text.

        A byte-level token has a character for each byte in the vocabulary, so the
        tokens' lengths tell where the chunks end.
        """
        out: list[bytes] = [b""] * len(chunks)
        fit = [k for k, c in enumerate(chunks) if c[0].isspace() and not c[-1].isspace()]
        apart = set(range(len(chunks))).difference(fit)
        at = 0
        while at < len(fit):
            size, part = 0, []
            while at < len(fit) and size < TOGETHER:
                part.append(fit[at])
                size += len(chunks[fit[at]])
                at += 1
            text = "".join([chunks[k] for k in part])
            sizes = map(len, [chunks[k] for k in part] if text.isascii() else [chunks[k].encode("utf-8", "surrogatepass") for k in part])
            ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            byte_ends = np.cumsum(self._byte_lengths[ids])
            want = np.cumsum(np.fromiter(sizes, np.int64, len(part)))
            ends = np.searchsorted(byte_ends, want) + 1
            if len(ids) and ends[-1] == len(ids) and (byte_ends[ends - 1] == want).all():
                data, start = ids.astype("<u4").tobytes(), 0
                for k, end in zip(part, (4 * ends).tolist()):
                    out[k] = data[start:end]
                    start = end
            else:  # never seen; a token that spans two chunks would land here
                apart.update(part)
        rest = sorted(apart)
        for k, ids in zip(rest, self._ids([chunks[k] for k in rest])):
            out[k] = ids
        return out

    @staticmethod
    def _odd_pieces(text: str) -> list[str] | None:
        """Chunk keys of a text in which other white space leads chunks than a space or a newline, or more than one; None for other texts."""
        odd = "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
        plain = text.isascii() and not any(c in text for c in _RARE_ASCII)
        if odd or (not plain and _RARE_SPACE.search(text) and _ODD_SPACE.search(text)):
            return ["\0" + c for c in _CHUNK.findall(text)]
        return None

    @staticmethod
    def _keys(text: str) -> str:
        """The chunk keys of any other text, with spaces between."""
        return "\0" + text.replace("\n", " \n")

    @classmethod
    def pieces(cls, text: str) -> list[str]:
        """Chunks of a text, each led by a space except where the chunk says otherwise.

        A chunk key starting with a newline, or with NUL for "as it stands", is
        encoded without a leading space.
        """
        found = cls._odd_pieces(text)
        return cls._keys(text).split(" ") if found is None else found

    @staticmethod
    def _surface(key: str) -> str:
        return key if key[0] == "\n" else key[1:] if key[0] == "\0" else " " + key

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; equal chunks are looked up once, and those that are new to the memo are encoded together."""
        whole = {k for k, t in enumerate(texts) if "\0" in t or any(a in t for a in self._added) or any(c in t for c in _CONTROL)}
        cut = [k for k, t in enumerate(texts) if t and k not in whole]
        odd = {k: self._odd_pieces(texts[k]) for k in cut}
        plain = [k for k in cut if odd[k] is None]
        rest = [k for k in cut if odd[k] is not None]
        by_space = pc.split_pattern(pa.array([self._keys(texts[k]) for k in plain], pa.large_string()), " ")
        keys = pa.concat_arrays([by_space.flatten(), pa.array([c for k in rest for c in odd[k]], pa.large_string())]).dictionary_encode()
        ids, ends = self._ids_of_keys(keys.dictionary.to_numpy(zero_copy_only=False).tolist(), keys.indices.to_numpy())
        data, at = ids.tobytes(), 0
        out: list[bytes] = [b""] * len(texts)
        counts = [*by_space.value_lengths().to_pylist(), *[len(odd[k]) for k in rest]]
        for k, end in zip([*plain, *rest], (4 * ends[np.cumsum(counts, dtype=np.int64) - 1]).tolist() if counts else ()):
            out[k], at = data[at:end], end
        for k in whole:
            out[k] = self._ids([texts[k]])[0]
        return out

    def _ids_of_keys(self, keys: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks ``keys[c]`` for c in ``codes``, one after another, and where each of them ends."""
        found = list(map(self._memo.get, keys))
        new: dict[str, bytes | None] = dict.fromkeys(compress(keys, map(is_, found, repeat(None))))
        if new:
            if len(self._memo) > self._max:
                self._old, self._memo = self._memo, {}
            new = {k: self._old.get(k) for k in new}
            missing = [k for k, v in new.items() if v is None]
            new.update(zip(missing, self._ids_of_chunks([self._surface(k) for k in missing])))
            self._memo.update(new)
            found = [new[k] if v is None else v for k, v in zip(keys, found)]
        pool = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        mine = lengths[codes]
        ends = np.cumsum(mine)
        places = np.repeat(starts[codes] - (ends - mine), mine)
        places += np.arange(len(places))
        return pool[places], ends


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> CachedByteBpe:
    """The worker's own encoder; Spark reuses workers, so the memo serves later tasks too."""
    return CachedByteBpe(path)
