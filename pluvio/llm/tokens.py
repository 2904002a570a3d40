"""Token ids of whole texts by the tokenizers library, with the ids of each pre-token remembered.

Byte-level BPE files cut a text into pre-tokens by a regular expression and encode each on its own. The cut is found here for
a whole batch from the classes of its characters, pre-tokens are looked up by a 64-bit hash of their characters, and the library's
model splits those not seen before. Every pre-token is compared, character by character, with the one whose ids it gets. Texts for which the cut might differ from the library's (special tokens inside, characters
outside the ranges below, other kinds of files) are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pluvio.llm.shingles import run_hashes

#: Characters that this module classes itself: Latin, Greek (without the final-form capital sigma), Cyrillic letters, general
#: punctuation, and the common Han block. Their classes and lower cases have not changed between versions of Unicode.
_RANGES = [(0x09, 0x0D), (0x20, 0x7E), (0xA0, 0x233), (0x391, 0x3A1), (0x3A4, 0x3A9), (0x3B1, 0x3C9), (0x410, 0x44F),
           (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC), (0x4E00, 0x9FA5)]
_UNKNOWN = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}".replace("\\", "\\\\").replace("]", "\\]") if a > 0x20 else
                                     f"\\x{a:02x}-\\x{b:02x}" for a, b in _RANGES) + "]")
LETTER, NUMBER, SPACE, OTHER, END = range(5)
_STOP = "￿"
#: The cut of byte-level pre-tokenizers, and the same without spaces and with single digits. Fixed values.
CUTS = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": "spaced",
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": "bare",
}
#: Characters cut at once.
SECTION = 1 << 19
#: Pre-tokens a process remembers.
REMEMBER = 3_000_000


def path_of(name: str) -> str:
    return public_tokenizers.path(name)


def _class_table() -> np.ndarray:
    out = np.full(65536, OTHER, np.int8)
    for a, b in _RANGES:
        for c in range(a, b + 1):
            kind = unicodedata.category(chr(c))[0]
            out[c] = SPACE if c in (9, 10, 11, 12, 13, 32, 0xA0) else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    out[ord(_STOP)] = END
    return out


def _shown() -> dict[int, str]:
    """The character by which byte-level vocabularies write a byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}


_SHOWN = _shown()


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids. No special tokens are added; those inside a text count."""

    def __init__(self, path: str, remember: int = REMEMBER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.remember = remember
        self.whole = Tokenizer.from_file(path)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut = self._cut_of(spec.get("pre_tokenizer") or {})
        self.lower = False
        normal = spec.get("normalizer")
        for step in [] if normal is None else normal.get("normalizers", [normal]):
            if step["type"] == "Lowercase":
                self.lower = True
            elif step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " " and self.cut == "bare":
                pass  # white space only parts words
            elif step["type"] != "NFC":  # NFC leaves the ranges above as they are
                self.cut = None
        self.classes = _class_table()
        self.forget()

    @staticmethod
    def _cut_of(pre: dict) -> str | None:
        steps = pre.get("pretokenizers", [pre])
        level = steps[-1]
        if level.get("type") != "ByteLevel" or level.get("add_prefix_space"):
            return None
        if len(steps) == 1 and level.get("use_regex"):
            return "spaced"
        first = steps[0]
        if len(steps) == 2 and not level.get("use_regex") and first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed":
            return CUTS.get(first["pattern"].get("Regex")) if CUTS.get(first["pattern"].get("Regex")) == "bare" else None
        return None

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # ascending; where the ids of each begin in flat, and how many there are
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.char_start = np.zeros(0, np.int64)  # where the characters of each are in chars, and how many there are
        self.char_count = np.zeros(0, np.int64)
        self.chars = np.zeros(1 << 16, np.uint16)
        self.chars_used = 0

    def _remember(self, keys: np.ndarray, words: list[str]) -> None:
        """Encode pre-tokens not known yet; keys ascending."""
        split = self.whole.model.tokenize
        own = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
        size = np.fromiter(map(len, words), np.int64, len(words))
        if self.chars_used + len(own) > len(self.chars):
            self.chars = np.concatenate([self.chars, np.zeros(len(self.chars) + len(own), np.uint16)])
        self.chars[self.chars_used:self.chars_used + len(own)] = own
        encoded = [[t.id for t in split(w.encode().decode("latin-1").translate(_SHOWN))] for w in words]
        count = np.fromiter(map(len, encoded), np.int64, len(encoded))
        total = int(count.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + total, np.uint32)])
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(encoded), np.uint32, total)
        at = np.searchsorted(self.keys, keys)
        self.char_start = np.insert(self.char_start, at, self.chars_used + np.cumsum(size) - size)
        self.char_count = np.insert(self.char_count, at, size)
        self.chars_used += len(own)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, self.used + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.used += total

    def _starts(self, codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin. The first and last character are stops."""
        begins = np.empty(len(kind), bool)
        begins[0] = True
        begins[1:] = kind[1:] != kind[:-1]
        begins |= kind == END
        if self.cut == "bare":
            begins |= kind == NUMBER
        quote = np.flatnonzero((codes == 0x27) & begins)
        quote = quote[(kind[quote + 1] == LETTER)]
        if self.cut == "spaced":
            # A run of white space keeps all but its last character; a last blank goes with what follows.
            last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
            begins[last] = True
            blank = last[codes[last] == 0x20]
            begins[blank + 1] = False
            quote = quote[codes[quote - 1] != 0x20]
        if len(quote):
            one, two = codes[quote + 1], codes[np.minimum(quote + 2, len(codes) - 1)]
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            for which, n in ((single, 1), (double & ~single, 2)):
                at = quote[which]
                begins[at + 1] = False
                begins[at + 1 + n] = True
        return np.flatnonzero(begins)

    def _section(self, texts: list[str]) -> list[np.ndarray]:
        joined = _STOP + _STOP.join(texts) + _STOP
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self.classes[codes]
        starts = self._starts(codes, kind)
        ends = np.append(starts[1:], len(codes))
        h = run_hashes(codes, starts, ends)
        stop = kind[starts] == END
        keep = ~stop if self.cut == "spaced" else ~stop & (kind[starts] != SPACE)
        token = np.flatnonzero(keep)
        distinct, first, inverse = np.unique(h[token], return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.remember:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        fresh = np.ones(len(distinct), bool)
        fresh[place < len(self.keys)] = self.keys[place[place < len(self.keys)]] != distinct[place < len(self.keys)]
        if fresh.any():
            at = token[first[fresh]]
            self._remember(distinct[fresh], [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            place = np.searchsorted(self.keys, distinct)
        where = place[inverse]
        wrong = self._differing(codes, starts[token], ends[token], where)
        counts, begin = self.count[where], self.start[where]
        done = np.cumsum(counts)
        total = int(done[-1]) if len(done) else 0
        flat = self.flat[np.repeat(begin - (done - counts), counts) + np.arange(total)]
        upto = np.searchsorted(token, np.flatnonzero(stop))
        bounds = np.concatenate([[0], done])[upto]
        out = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for k in np.unique(np.searchsorted(upto, wrong, side="right") - 1).tolist():
            out[k] = np.array(self.whole.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        return out

    def _differing(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Pre-tokens that are not the remembered ones at these places, though their hashes are equal."""
        size = ends - starts
        wrong = size != self.char_count[where]
        whose = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(whose)) - np.repeat(np.cumsum(size) - size, size)
        stored = np.minimum(self.char_start[where][whose] + inside, len(self.chars) - 1)
        wrong[whose[codes[starts[whose] + inside] != self.chars[stored]]] = True
        return np.flatnonzero(wrong)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        held = 0

        def flush():
            nonlocal held
            if waiting:
                for (k, _), got in zip(waiting, self._section([t for _, t in waiting]), strict=True):
                    out[k].append(got)
                waiting.clear()
            held = 0

        for k, text in enumerate(texts):
            if self.cut is None or _UNKNOWN.search(text) or any(s in text for s in self.specials):
                sound = text.encode("utf-8", "replace").decode()
                out[k].append(np.array(self.whole.encode(sound, add_special_tokens=False).ids, np.uint32))
                continue
            text = text.lower() if self.lower else text
            for piece in _pieces(text):
                waiting.append((k, piece))
                held += len(piece)
                if held >= SECTION:
                    flush()
        flush()
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.uint32), *x]) for x in out]


def _pieces(text: str) -> list[str]:
    """Parts of a long text, cut before single blanks, where pre-tokens always part."""
    parts = []
    while len(text) > SECTION:
        at = SECTION
        while at < len(text):
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                return [*parts, text]
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        parts.append(text[:at])
        text = text[at:]
    return [*parts, text]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a file; what it remembers outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
