"""Token ids of ``word_bpe_49k.json`` with every different word of a batch encoded once.

The tokenizer drops white space between words, so a text's ids are its words' ids
one after another, and words repeat. A word of Latin-1 characters is lower-cased and
split here by the tokenizer's own pattern, and its parts, of which the recent ones are
kept, are handed to its BPE model; any other word goes through the whole tokenizer. The
result is that of ``Tokenizer.encode``.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from .common import worker_cache

MODEL = "word_bpe_49k.json"
RECENT = 250_000  # parts, about 150 bytes each, and twice as many at most
TEXTS_AT_ONCE = 4_000_000  # bytes; the more, the fewer words come twice
LONG = 64  # characters of a word from which its parts are not kept
PARTS_AT_ONCE = 20_000

# Words of visible Latin-1 characters. Lower-casing and NFC stay inside that range.
_PLAIN = r"^[\x21-\x7e\x{a1}-\x{ac}\x{ae}-\x{ff}]+$"
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
# Fixed: the alternatives of the tokenizer's pattern, in its order, over Latin-1; and the
# space that is put between words here.
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER} ]+| ")
# White space to str.split() but not to the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


class Recent:
    """Values of the last ``most`` different keys at least, and of twice as many at most."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, keys: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The values, and the positions of those that are not known."""
        found, unknown = list(map(self.young.get, keys)), []
        for k in [k for k, value in enumerate(found) if value is None]:
            if (value := self.old.get(keys[k])) is None:
                unknown.append(k)
            else:
                found[k] = self.young[keys[k]] = value
        return found, unknown

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


def strings(values: pa.Array) -> list[str]:
    """The values of an array without nulls; ``to_pylist`` takes several times as long."""
    return values.to_numpy(zero_copy_only=False).tolist()


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after another."""
    ends = np.cumsum(sizes)
    index = np.repeat(starts - (ends - sizes), sizes)
    index += np.arange(len(index))
    return flat[index]


class WordIds:
    """Texts -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str | None = None, recent: int = RECENT):
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(MODEL))
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # parts are kept here instead
        self.plain = Tokenizer(self.model)  # of parts that are ready for the merges
        self.plain.pre_tokenizer = CharDelimiterSplit(" ")
        self.parts = Recent(recent)
        self.table = {ord(chr(b)): c for b, c in _byte_characters().items()}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each word begin and how many they are."""
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(pc.match_substring(words, "<|"))).to_numpy(zero_copy_only=False)
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ids = np.zeros(0, "<u4")
        if plain.any():
            latin = words.filter(pa.array(plain))
            # Every word's parts, a space after each word.
            cut = pa.array(_PARTS.findall(" ".join(strings(latin)).lower() + " "), pa.string()).dictionary_encode()
            codes, between = cut.indices.to_numpy(), pc.equal(cut.dictionary, " ").to_numpy(zero_copy_only=False)
            of_word = np.repeat(np.arange(len(latin)), np.diff(np.flatnonzero(between[codes]), prepend=-1))
            long = (pc.utf8_length(latin).to_numpy() > LONG)[of_word]
            passing = np.zeros(len(between), bool)
            passing[codes[long]] = True
            passing[codes[~long]] = False
            packed = self.of_parts(strings(cut.dictionary), passing.tolist())
            lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            lengths[between] = 0
            begins = np.cumsum(lengths) - lengths
            ids = gathered(np.frombuffer(b"".join(packed), "<u4"), begins[codes], lengths[codes])
            sizes[plain] = np.bincount(of_word, lengths[codes], len(latin)).astype(np.int64)
            starts[plain] = np.cumsum(sizes[plain]) - sizes[plain]
        rest = np.flatnonzero(~plain)
        others = [self.whole(words[int(k)].as_py()) for k in rest]
        sizes[rest] = np.fromiter(map(len, others), np.int64, len(others)) // 4
        starts[rest] = len(ids) + np.cumsum(sizes[rest]) - sizes[rest]
        return np.concatenate([ids, np.frombuffer(b"".join(others), "<u4")]), starts, sizes

    def of_parts(self, parts: list[str], passing: list[bool]) -> list[bytes]:
        """The ids of different parts; unknown ones go through the BPE model in few calls,
        and stay unless they are ``passing``. None of a space."""
        found, unknown = self.parts.get(parts)
        for first in range(0, len(unknown), PARTS_AT_ONCE):
            some = [k for k in unknown[first : first + PARTS_AT_ONCE] if parts[k] != " "]
            shown = [parts[k] if parts[k].isascii() else parts[k].encode().decode("latin-1").translate(self.table) for k in some]
            encoding = self.plain.encode(" ".join(shown), add_special_tokens=False)
            ends = np.cumsum(np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(some))) * 4
            packed, begin = np.array(encoding.ids, "<u4").tobytes(), 0
            for k, end in zip(some, ends.tolist(), strict=True):
                found[k], begin = packed[begin:end], end
                if not passing[k]:
                    self.parts.put(parts[k], found[k])
        return [ids or b"" for ids in found]

    def encode_batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text as an array; each different word of the batch is looked up once."""
        texts = texts.cast(pa.string()).fill_null("")
        odd = np.zeros(len(texts), bool)
        for separator in _SEPARATORS:
            odd |= pc.match_substring(texts, separator).to_numpy(zero_copy_only=False)
        lists = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", texts))
        words = lists.flatten().dictionary_encode()
        flat, starts, sizes = self.of_words(words.dictionary)
        codes = words.indices.to_numpy()
        ids = gathered(flat, starts[codes], sizes[codes])
        of_word = np.append(0, np.cumsum(sizes[codes]))
        bounds = of_word[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))]
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for k in np.flatnonzero(odd):
            out[k] = np.frombuffer(self.whole(texts[int(k)].as_py()), "<u4")
        return out


def word_ids(path: str | None = None) -> WordIds:
    """One per Python worker, kept from task to task."""
    return worker_cache(f"word ids {path}", lambda: WordIds(path))
