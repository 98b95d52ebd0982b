"""Token ids of whole texts as the public libraries give them.

A tokenizer that splits text before it merges gives a word the same ids wherever
the word stands, so each worker keeps the ids of words, up to ``MEMO_BYTES``. Text is cut
only where the split is proven to fall in any surroundings:

``spaced``  byte-level split, nothing normalised: before a single space between two
            characters that are no white space. Every alternative of the split
            pattern has its space, if any, in front, and a run of white space ends
            at either character.
``dropped`` white space squeezed and left out of every piece: at any space or newline.

Special strings hold no space, so no cut falls into one. Any other tokenizer encodes
whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import cache

#: A cut may stand before a space between two of these.
PLAIN = r"[\w!-~]"
_CUT = re.compile(rf"(?<={PLAIN})(?= {PLAIN})")
_PLAIN_ENDS = re.compile(rf"{PLAIN}(?s:.*{PLAIN})?")
#: Fixed value: the split of ``word_bpe_49k.json``, which leaves white space out.
_DROPPING_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word of printed ASCII and Latin-1 letters, which lower-case and split alike everywhere;
#: none with the mark that special strings start with. Newlines stand in byte-level words.
_LATIN = re.compile(r" ?[\n!-;=-~À-ÖØ-öø-ÿ]+")
#: The same splits where only such characters occur.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_SIGNS = r"[!-/:-@\[-`{-~]"
_LATIN_SPLITS = {
    "dropped": rf"'s|'t|'re|'ve|'m|'ll|'d|{_LETTERS}+|[0-9]|{_SIGNS}+",
    "spaced": rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_LETTERS}+| ?[0-9]+| ?{_SIGNS}+|\s+(?!\S)|\s+",
}
#: Bytes of words and ids that a worker keeps, their objects and places included.
MEMO_BYTES = 64_000_000
_ENTRY_BYTES = 120
#: Signs between a letter and white space are a piece by themselves in either split; none of
#: those that special strings start and end with.
_ENDING = r"[!-/:;=?@\[-`{}~]"
_STOP = re.compile(rf"{_ENDING}(?<={_LETTERS}.){_ENDING}*(?=[ \n])")
#: Stands in front of a word that follows the one before without a space.
_MARK = "\0"


def cut_mode(path: str) -> str | None:
    """``spaced`` or ``dropped`` where the tokenizer file proves it, else None."""
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = [token["content"] for token in spec["added_tokens"]]
    plain = not any(token["lstrip"] or token["rstrip"] for token in spec["added_tokens"])
    if not plain or any(re.search(r"\s", text) or text[0] != "<" for text in special):
        return None
    split, normal = spec["pre_tokenizer"] or {}, spec["normalizer"]
    if split.get("type") == "ByteLevel":
        whole = normal is None and split["use_regex"] and not split["add_prefix_space"]
        return "spaced" if whole else None
    steps = split.get("pretokenizers") or [{}]
    normals = (normal or {}).get("normalizers") or []
    squeezed = any(
        x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "
        for x in normals
    )
    by_word = all(x["type"] in ("NFC", "Replace", "Lowercase") for x in normals)
    first = steps[0]
    drops = first.get("pattern") == {"Regex": _DROPPING_SPLIT} and first.get("invert")
    level = len(steps) == 2 and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"]
    whole = level and not steps[1]["add_prefix_space"]
    if squeezed and by_word and drops and first["behavior"] == "Removed" and whole:
        return "dropped"
    return None


def cuts(text: str, mode: str) -> set[int]:
    """The places of ``text`` at which the mode proves a token to start or end."""
    if mode == "dropped":
        return {i for i, c in enumerate(text) if c in " \n"}
    return {match.start() for match in _CUT.finditer(text)}


class _Memo(dict):
    """Ids by word, made when a word is first met; None for a word without ids of its own.

    Half of ``MEMO_BYTES`` is for words met since the last turn, half for those of the turn
    before. A full turn replaces the one before, so words in use stay and others go.
    """

    def __init__(self, make: Callable[[str], bytes | None]):
        self._make, self._older, self._left = make, {}, MEMO_BYTES // 2

    def __missing__(self, word: str) -> bytes | None:
        ids = self._older.get(word)
        if ids is None:
            ids = self._make(word)
        self._left -= _ENTRY_BYTES + len(word)
        if self._left < 0:
            self._older, self._left = dict(self), MEMO_BYTES // 2
            self.clear()
        self[word] = ids
        return ids


class Codec:
    """Ids of whole texts, without begin, end or added special tokens.

    Special strings inside a text are handled as the library does by default;
    nothing is cut off or padded. Words of plain Latin characters are split by the
    tokenizer's pattern and go straight to the library's model; all others take the
    library's whole way.
    """

    def __init__(self, path: str):
        self.mode = cut_mode(path)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._whole = lambda text: _packed(model.encode(text, num_threads=1))
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._whole = lambda text: _packed(self.library.encode(text, add_special_tokens=False).ids)
        if self.mode:
            self._model, self._letters = self.library.model, _byte_letters()
            self._split = re.compile(_LATIN_SPLITS[self.mode]).findall
            self._memo = _Memo(self._lowered if self.mode == "dropped" else self._after_space)

    def _after_space(self, word: str) -> bytes | None:
        """Ids of a space and the word, or of the rest of one that starts with ``_MARK``.

        A word at whose ends the cut is not proven has no ids of its own.
        """
        if word.isalpha():
            if word.isascii():
                return self._ids(f"Ġ{word}")
            if _LATIN.fullmatch(word):
                return self._merged(f" {word}")
        if word.startswith(_MARK):
            rest = word[1:]
            return self._word(rest) if _PLAIN_ENDS.fullmatch(rest.lstrip("\n")) else None
        return self._word(f" {word}") if _PLAIN_ENDS.fullmatch(word) else None

    def _lowered(self, word: str) -> bytes:
        """Ids of a word where neither space nor case counts."""
        if not _LATIN.fullmatch(word):
            return self._whole(word)
        low = word.lower()
        if low.isalpha():
            return self._merged(low) if low == word else self._memo[low]
        return b"".join(map(self._merged, self._split(low)))

    def _word(self, word: str) -> bytes:
        """Ids of a word as it stands."""
        if self.mode == "dropped":
            return self._lowered(word)
        if not _LATIN.fullmatch(word):
            return self._whole(word)
        if word.isalpha() or word[0] == " " and word[1:].isalpha():
            return self._merged(word)
        return b"".join(map(self._merged, self._split(word)))

    def _merged(self, piece: str) -> bytes:
        """Ids of one piece of the split, by the library's model."""
        if piece.isascii() and "\n" not in piece:
            return self._ids(piece.replace(" ", "Ġ"))
        return self._ids(piece.encode().decode("latin-1").translate(self._letters))

    def _ids(self, letters: str) -> bytes:
        return _packed([x.id for x in self._model.tokenize(letters)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.mode:
            return self._whole(text)
        ids = self._memo.__getitem__
        if self.mode == "dropped":
            return b"".join(map(ids, _STOP.sub(r" \g<0>", text).replace("\n", " ").split(" ")))
        # One newline between two plain characters is a piece by itself: a cut goes before it.
        cut = f" {_MARK}"
        first, *rest = _STOP.sub(rf"{cut}\g<0>", text).replace("\n", f"{cut}\n").split(" ")
        if rest and _PLAIN_ENDS.fullmatch(first) and _MARK not in text:
            try:
                return self._word(first) + b"".join(map(ids, rest))
            except TypeError:
                pass
        first, *rest = _CUT.split(text)
        parts = [ids(part[1:]) or self._word(part) for part in rest]
        return b"".join([self._word(first) if first else b"", *parts])


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Bytes that print stand for themselves, the others for the letters from 256 on.
    """
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printed]
    return {byte: chr(256 + place) for place, byte in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@cache
def codec(path: str) -> Codec:
    """One per worker process, which Spark keeps from task to task."""
    return Codec(path)
