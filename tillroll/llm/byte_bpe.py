"""A byte-level BPE tokenizer read from its .json file, and what is proven about it."""

from __future__ import annotations

import json
import re
from functools import lru_cache

# The pre-token pattern of this family of tokenizers, for the characters of
# Latin scripts and common signs, where all Unicode versions agree on classes.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\t\n\x0b\x0c\r\x20\u00a0"
PRE_TOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
KNOWN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\u00a0-ɏ‐-‧€]*")
#: Pre-tokens begin at a space before a visible character, whatever stands around.
_WORD = re.compile(f" (?=[^{_SPACE}])")


PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """The library's tokenizer, loaded when it is needed, with a cut into words that it
    provably respects.

    `simple` tells whether the file says what the cut relies on: byte-level pre-tokens by
    the pattern above, no normalizer, no prefix space, added tokens taken as they stand.
    """

    def __init__(self, path: str):
        self.path, self.loaded = path, None
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut = parts["pre_tokenizer"] or {}
        self.added = [token["content"] for token in parts["added_tokens"]]
        self.vocabulary = parts["model"]["vocab"]
        self.simple = (
            parts["normalizer"] is None
            and (cut.get("type"), cut.get("use_regex")) == ("ByteLevel", True)
            and not cut.get("add_prefix_space")
            and parts["model"].get("dropout") is None
            and not any(t["lstrip"] or t["rstrip"] for t in parts["added_tokens"])
        )

        self.ranked = self._ranked(parts["model"]["merges"]) if self.simple else None

    def _ranked(self, merges: list):
        """The same merges in the other library, which is five times as fast on short words;
        only if every merge makes the next id, so that ids rank them. Else None."""
        import tiktoken

        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        alphabet, taken = byte_alphabet(), set(self.added)
        made = [self.vocabulary.get("".join(pair)) for pair in pairs]
        if made != list(range(256, 256 + len(made))):
            return None
        ranks = {
            bytes(alphabet[c] for c in token): number
            for token, number in self.vocabulary.items()
            if token not in taken
        }
        return tiktoken.Encoding(
            "ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of each text, without special tokens around it."""
        if self.ranked is None:
            return self._library(texts)
        known = [self.can_cut(text) for text in texts]
        rest = iter(self._library([t for t, fast in zip(texts, known, strict=True) if not fast]))
        fast_ids = self.ranked.encode_ordinary
        return [fast_ids(t) if fast else next(rest) for t, fast in zip(texts, known, strict=True)]

    def _library(self, texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        if self.loaded is None:
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.path)
            self.loaded.no_truncation()
            self.loaded.no_padding()
        return [x.ids for x in self.loaded.encode_batch(texts, add_special_tokens=False)]

    def can_cut(self, text: str) -> bool:
        """False for texts with an added token, or with a character that Unicode versions
        class differently; they go to the library whole."""
        known = self.simple and KNOWN.fullmatch(text) is not None
        return known and not any(token in text for token in self.added)

    def words(self, text: str) -> list[str]:
        """Parts whose ids, one after another, are the ids of the text."""
        if not text:
            return []
        if not self.can_cut(text):
            return [text]
        first, *rest = _WORD.split(text)
        return ([first] if first else []) + [" " + word for word in rest]


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Strings of the vocabulary that the library encodes alone as just that one token.

    Not all do: some are made by merges that others forestall, some are parts of characters,
    some fall into two pre-tokens. The proof is the encoding itself, once per process.
    """
    bpe, alphabet = byte_bpe(path), byte_alphabet()
    texts, ids = [], []
    for token, token_id in bpe.vocabulary.items():
        try:
            text = bytes(alphabet[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if KNOWN.fullmatch(text) and PRE_TOKEN.fullmatch(text):
            texts.append(text)
            ids.append(token_id)
    found = bpe._library(texts)
    return frozenset(t for t, i, got in zip(texts, ids, found, strict=True) if got == [i])
