"""Token ids of byte-level BPE and sentencepiece files, and the bytes behind the ids.

``BytePairs`` reads a byte-level BPE file of ``tokenizers``.  Its vocabulary and
merges are handed to ``tiktoken``, which applies the same merges to the same
words several times faster; a text that ``tiktoken`` cannot be sure to treat alike
(special tokens that count as such, runs of white space beyond its regex
stack) is encoded by the tokenizer itself.

``Pieces`` reads a sentencepiece model.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

#: Where byte-level tokenizers of this family cut a text into words (fixed by them).
WORDS_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: sentencepiece's mark for a blank.
BLANK = "▁"


class BytePairs:
    """A byte-level BPE file: ids of a text, and the bytes of each id (``pieces``)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.marked, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        spec = json.loads(self.marked.to_str())
        if not isinstance(self.marked.pre_tokenizer, ByteLevel) or spec["normalizer"] or spec["model"]["type"] != "BPE":
            raise ValueError("a byte-level BPE tokenizer without normaliser is needed")
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        byte_of = {spell.pre_tokenize_str(c)[0][0][-1]: c.encode()[-1] for c in map(chr, range(256))}
        byte_of |= {c: b for b, c in zip(sorted(set(range(256)) - set(byte_of.values())), sorted(set(ByteLevel.alphabet()) - set(byte_of)))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        merged = [ranks[bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]
        self.pieces = [b""] * (1 + max(spec["model"]["vocab"].values(), default=0))
        for token, i in ranks.items():
            self.pieces[i] = token
        self.fast = None
        if merged == sorted(merged) and sorted(ranks.values()) == list(range(len(ranks))):  # ids rise with merges
            self.fast = tiktoken.Encoding("byte pairs", pat_str=WORDS_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, special: bool) -> np.ndarray:
        """Ids of a text; ``special``: strings of special tokens count as these, else as plain text."""
        if self.fast is not None and not (special and any(t in text for t in self.special)):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # white space too long for its regex
                pass
        return np.asarray((self.marked if special else self.plain).encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """A sentencepiece model: ids of texts, and the bytes of each id (``pieces``)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(2)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


@lru_cache(2)
def sentence_pieces(path: str) -> Pieces:
    return Pieces(path)
