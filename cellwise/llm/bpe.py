"""Byte-pair encoding and decoding by per-prefix dynamic programming (operator 5).

For every prefix of a pre-token, BPE has exactly one result, so it is enough
to store the *last* token of that result.  An Aho-Corasick automaton over the
vocabulary yields all tokens that end at a position; of these exactly one is
compatible with the last token stored for the prefix before it.  Following
the back-pointers from the end gives the ids.  Linear in the text for any
input, also for very long runs without a break, where repeated merging is
quadratic.

Pre-tokens repeat, so each task keeps bounded caches of their ids.
"""

from __future__ import annotations

import json
import re
from array import array

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The split pattern of the byte-level vocabulary. White space is
# spelled out as the Unicode property so that no control character is added.
SPACE = r"\p{White_Space}"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|"
           + SPACE + r"+(?!" + r"[^" + SPACE + r"])|" + SPACE + r"+")

#: Entries of a cache; a full cache is emptied, so memory is bounded.
CACHE_ENTRIES = 600_000
CACHE_CHARS = 48
_NEXT_BLANK = re.compile(r" (?=\s|$)")


def byte_symbols() -> dict[str, int]:
    """Printable symbol -> byte, as byte-level vocabularies write bytes: the
    printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixBPE:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.piece: dict[int, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if token in self.special:
                self.piece[i] = token.encode()
                continue
            raw = bytes(symbols[c] for c in token)
            self.piece[i] = raw
            self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()
        for token, i in self.special.items():
            self.piece[i] = token.encode()
        self.merge: dict[tuple[int, int], int] = {}
        self.made_at: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.merge.setdefault((a, b), rank)
            if whole not in self.made_at:
                self.made_at[whole], self.halves[whole] = rank, (a, b)
        self.fast_split = regex.compile(PATTERN).findall
        self.own_split = tokenizers.pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.special_split = (re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
                              if self.special else None)
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE over the joined bytes of both tokens ends with them.

        Undo the merges inside the two tokens from the latest on; if at any
        time the two symbols at the border could have been merged before the
        merge just undone, the border would not have survived.  Of equal
        ranks the leftmost merge happens first.
        """
        key = (left, right)
        merge, made_at, halves = self.merge, self.made_at, self.halves
        limit = len(merge) + 1
        while True:
            across = merge.get((left, right))
            if across is not None and across < limit:
                ok = False
                break
            a, b = made_at.get(left, -1), made_at.get(right, -1)
            if a < 0 and b < 0:
                ok = True
                break
            if a > b:
                limit, left = a, halves[left][1]
            else:
                limit, right = b + 1, halves[right][0]
        if len(self.fits) >= 4 * CACHE_ENTRIES:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(raw)
        last = [-1] * (n + 1)   # last token of each prefix
        begin = [0] * (n + 1)   # where that token begins
        known, fits = self.fits.get, self.compatible
        for end, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                ok = known((last[start], token))
                if ok is None:
                    ok = fits(last[start], token)
                if not ok:
                    continue
            last[end], begin[end] = token, start
        ids = []
        while n:
            ids.append(last[n])
            n = begin[n]
        ids.reverse()
        return ids

    def encode_word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.encode_piece(word.encode("utf-8", "surrogatepass"))
            if len(word) <= CACHE_CHARS:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def split(self, text: str) -> list[str]:
        """Pre-tokens.  Beyond the old, settled blocks the tokenizer's own
        splitter decides, as Unicode versions differ on which newly assigned
        characters are letters."""
        if text.isascii() or max(text) < "\u0800":
            # A blank and letters are one pre-token by the pattern.
            return [text] if text[1:].isalpha() and text[0] == " " else self.fast_split(text)
        return [text[a:b] for _, (a, b) in self.own_split(text)]

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        out: list[int] = []
        for w in self.split(text):
            out += self.encode_word(w)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens written in it become their ids."""
        out: list[int] = []
        for part in self.parts(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.encode_plain(part)
        return out

    def parts(self, text: str) -> list[str]:
        return [x for x in self.special_split(text) if x] if self.special_split else [text]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.piece.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def chunks(text: str) -> list[str]:
    """The text cut before each blank that a visible character follows.

    The split pattern always begins a pre-token there, so chunks can be
    encoded on their own; they repeat like words do.
    """
    if not text:
        return []
    parts = text.split(" ")
    if _NEXT_BLANK.search(text) is None:
        head = parts[:1] if parts[0] else []
        return head + [" " + p for p in parts[1:]]
    out, held = [], parts[0]
    for p in parts[1:]:
        if p and not p[0].isspace():
            if held:
                out.append(held)
            held = " " + p
        else:
            held += " " + p
    out.append(held)
    return out


class ChunkTable(dict):
    """chunk -> ``make(ids)``, filled on first use and emptied when full."""

    def __init__(self, bpe: PrefixBPE, make):
        super().__init__()
        self.bpe, self.make = bpe, make

    def __missing__(self, chunk: str):
        value = self.make(self.bpe.encode_plain(chunk))
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = value
        return value


_LOADED: dict[str, PrefixBPE] = {}


def load(path: str) -> PrefixBPE:
    """The tokenizer file's encoder, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PrefixBPE(path)
    return _LOADED[path]


_IDS: dict[str, ChunkTable] = {}


def id_bytes(text: str, path: str) -> bytes:
    """All ids of a text as little-endian unsigned 32-bit numbers."""
    bpe = load(path)
    if path not in _IDS:
        _IDS[path] = ChunkTable(bpe, lambda ids: b"".join(i.to_bytes(4, "little") for i in ids))
    table = _IDS[path]
    out = []
    for part in bpe.parts(text):
        if part in bpe.special:
            out.append(bpe.special[part].to_bytes(4, "little"))
        else:
            out += map(table.__getitem__, chunks(part))
    return b"".join(out)


_RANKED: dict[str, object] = {}


def ranked(path: str):
    """A tiktoken encoder with the file's ids, once per Python worker; None if
    its merges are not in the order of their ids, which that library assumes."""
    if path not in _RANKED:
        import tiktoken

        bpe = load(path)
        by_id = [bpe.made_at[i] for i in sorted(bpe.made_at)]
        plain = {p: i for i, p in bpe.piece.items() if i not in bpe.special.values()}
        _RANKED[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=plain,
                                          special_tokens={}) if by_id == sorted(by_id) else None
    return _RANKED[path]


#: The library's splitter needs stack for every blank of a run and ends the
#: worker at about a million of them; its errors are no Python exceptions.
_LONG_BLANK = re.compile(r"(?<!\s)\s{100000}")


def library_id_bytes(text: str, path: str) -> bytes:
    """As :func:`id_bytes`, by a library's merge loop where it splits alike:
    texts without special tokens, recent Unicode blocks and very long runs of
    white space."""
    bpe, fast = load(path), ranked(path)
    if (fast is None or (text and max(text) >= "\u0800") or any(t in text for t in bpe.special)
            or len(text) >= 100_000 and _LONG_BLANK.search(text)):
        return id_bytes(text, path)
    return array("I", fast.encode_ordinary(text)).tobytes()


def encode_ids(texts: pd.Series, path: str) -> pd.Series:
    import numpy as np

    return pd.Series([np.frombuffer(id_bytes(t or "", path), dtype="<u4").astype("int64")
                      for t in texts], dtype=object)


def encode_column(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus ``out``: the ids of the whole text (null: empty array)."""
    udf = F.pandas_udf(lambda s: encode_ids(s, path), "array<long>")
    return docs.withColumn(out, udf(F.col(f"`{text_col}`").cast("string")))


def decode_column(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` plus ``out``: the text of an id array (null: empty)."""
    def run(s: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.decode([] if x is None else x) for x in s], dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "string")(F.col(f"`{ids_col}`")))


_TEXTS: dict[str, ChunkTable] = {}


def digest(text: str | None, path: str) -> tuple[int, str, str]:
    """(number of ids, sha256 of the decimal ids, sha256 of the decoded text)."""
    from hashlib import sha256

    bpe = load(path)
    if path not in _TEXTS:
        _TEXTS[path] = ChunkTable(
            bpe, lambda ids: (len(ids), ",".join(map(str, ids)), bpe.decode_bytes(ids)))
    table = _TEXTS[path]
    found = []
    for part in bpe.parts(text or ""):
        if part in bpe.special:
            found.append((1, str(bpe.special[part]), bpe.piece[bpe.special[part]]))
        else:
            found += map(table.__getitem__, chunks(part))
    if not found:
        empty = sha256(b"").hexdigest()
        return 0, empty, empty
    counts, ids, raw = zip(*found)
    # Back through text, as decode() does: broken sequences are replaced.
    decoded = b"".join(raw).decode("utf-8", "replace").encode()
    return sum(counts), sha256(",".join(ids).encode()).hexdigest(), sha256(decoded).hexdigest()


def roundtrip_digests(docs: DataFrame, path: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256.

    Null text counts as empty (no ids, digests of the empty string); rows are
    independent, so repeated rows and extra columns do not matter.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([digest(t, path) for t in s], columns=names)

    udf = F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        udf(F.col(f"`{text_col}`").cast("string")).alias("_d"))
            .select("doc_id", "_d.*"))
