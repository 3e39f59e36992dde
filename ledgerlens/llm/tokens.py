"""Word-level byte-pair encoding by per-prefix dynamic programming, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Letters and numbers that are younger than the tokenizers library's word pattern, which takes them for symbols, and
#: capitals (with the distance to their small letters) that it knows and the standard module does not.
_YOUNG = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959"
    "\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
    "\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
_CAPITALS = {0x1C89: 1, 0xA7CB: -42343, 0xA7CC: 1, 0xA7CE: 1, 0xA7D2: 1, 0xA7D4: 1, 0xA7DA: 1, 0xA7DC: -42561}
_CAPITALS |= dict.fromkeys(range(0x10D50, 0x10D66), 32) | dict.fromkeys(range(0x16EA0, 0x16EB9), 27)
_SMALL = {c: c + d for c, d in _CAPITALS.items()}
_WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_YOUNG}]]+|[\p{{N}}--[{_YOUNG}]]|(?:[^\s\p{{L}}\p{{N}}]|[{_YOUNG}])+", regex.V1
)
# the same classes spelled out for Latin-1, where the standard module is twice as fast
_LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
_BEYOND_LATIN = re.compile("[^\0-ÿ]")
_END = "</w>"
_FINAL = 0xE000
_CACHE_WORDS = 500_000
_LOADED: dict[str, WordCoder] = {}


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself if it is a visible Latin-1 character, else the next from U+0100."""
    out, extra = [], 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class _Ids(dict):
    """Encoded words met so far; a new one is encoded when it is asked for."""

    def __init__(self, coder: WordCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        out = self[word] = np.array(self.coder.encode_word(word), "<u4").tobytes()
        return out


class WordCoder:
    """Exact ids of a word without replaying merges.

    The encoding of a prefix of a word is a prefix of encodings: every prefix has one encoding, hence one last token. It
    is the token that ends there, stands for itself alone, and is compatible with the last token of what precedes it.
    Two tokens are compatible if their joined letters encode to just these two. An automaton over the vocabulary
    lists the tokens that end at each letter; back-pointers give the ids. The letter that ends a word is a letter of its own.
    """

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.letters = byte_letters()
        fold = self._fold
        self.id = {fold(k): v for k, v in model["vocab"].items()}
        self.letter_of = {k: i for i, k in enumerate(self.letters)}
        self.token: dict[int, str] = {v: k for k, v in model["vocab"].items()} | {v: k for k, v in self.special.items()}
        self.folded = {v: k for k, v in self.id.items()}
        self.rank = {tuple(map(fold, m)): i for i, m in enumerate(model["merges"])}
        self.automaton = ahocorasick.Automaton()
        for k, v in self.id.items():
            self.automaton.add_word(k, (len(k), v))
        self.automaton.make_automaton()
        self.alone: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.cache = _Ids(self)
        self.split_special = regex.compile("(" + "|".join(regex.escape(k) for k in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    @staticmethod
    def _fold(token: str) -> str:
        """The letter before the end mark becomes a letter of a private range."""
        if token.endswith(_END) and len(token) > len(_END):
            body = token[: -len(_END)]
            return body[:-1] + chr(_FINAL + ord(body[-1]))
        return token

    def merged(self, letters: str) -> list[str]:
        """Reference merging, for single tokens and pairs of tokens only."""
        parts = list(letters)
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[best] == 1 << 60:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def stands(self, t: int) -> bool:
        if t not in self.alone:
            self.alone[t] = self.merged(self.folded[t]) == [self.folded[t]]
        return self.alone[t]

    def fits(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.folded[left], self.folded[right]
            known = self.stands(right) and self.merged(a + b) == [a, b]
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def encode_word(self, word: str) -> list[int]:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] = chr(_FINAL + ord(letters[-1]))
        folded = "".join(letters)
        whole = self.id.get(folded)
        if whole is not None and self.stands(whole):
            return [whole]
        n = len(folded)
        last, back = [-1] * (n + 1), [-1] * (n + 1)
        pairs, fits = self.pairs, self.fits
        for end, (size, t) in self.automaton.iter(folded):
            stop = end + 1
            if last[stop] >= 0:
                continue
            start = stop - size
            if start == 0:
                if self.stands(t):
                    last[stop], back[stop] = t, 0
                continue
            left = last[start]
            if left >= 0:
                known = pairs.get(left << 20 | t)
                if known or known is None and fits(left, t):
                    last[stop], back[stop] = t, start
        out, at = [], n
        while at > 0:
            if last[at] < 0:
                raise ValueError(f"the vocabulary has no encoding of {word[:40]!r}")
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # lower-cased letter by letter: a final sigma is an ordinary sigma; white space only separates words
        text = text.replace("Σ", "σ").lower()
        wide = _BEYOND_LATIN.search(text)
        if len(self.cache) > _CACHE_WORDS:
            self.cache = _Ids(self)
        return b"".join(map(self.cache.__getitem__, _WORDS.findall(text.translate(_SMALL)) if wide else _LATIN.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.special or "<" not in text:
            return self._plain(text)
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in self.split_special.split(text) if p
        )

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space, as a tokenizer without a decoder gives them."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def loaded(text: str) -> WordCoder:
    """One coder per worker and vocabulary."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordCoder(text)
    return _LOADED[key]


RESULTS = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode_documents(docs: DataFrame, vocabulary: str, results: tuple[str, ...] = ("ids", "decoded"), text: str = "text") -> DataFrame:
    """Adds the encoding of every whole text; null counts as empty and gives no ids.

    `results` names what is added: n_tokens, ids (little-endian unsigned 32-bit integers), decoded, and the SHA-256 of ids or
    decoded text. Columns with these names are replaced, all others kept. `vocabulary` is the content of a tokenizer file
    (BPE with word ends); it is sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [f for f in docs.schema.fields if f.name not in results]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{k} {RESULTS[k]}" for k in results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [coder.encode(t) if t else b"" for t in part.column(text).to_pylist()]
                decoded = [coder.decode(x) for x in ids] if "decoded" in results or "decoded_sha256" in results else []
                made = {
                    "n_tokens": lambda: pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids": lambda: pa.array(ids, pa.binary()),
                    "ids_sha256": lambda: pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded": lambda: pa.array(decoded, pa.string()),
                    "decoded_sha256": lambda: pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                }
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [made[k]() for k in results], names=[f.name for f in kept] + list(results))

    return docs.mapInArrow(run, schema)
