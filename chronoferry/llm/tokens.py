"""Token ids of texts by the installed SentencePiece library, each distinct word encoded once."""

from __future__ import annotations

from itertools import chain

import numpy as np
from sentencepiece import SentencePieceProcessor

from chronoferry.llm.pieces import SPACE, Pieces


class Tokenizer(Pieces):
    """Like its base, but units that aren't remembered go to the library's own encoder."""

    def __init__(self, model: bytes) -> None:
        super().__init__(model)
        self.processor = SentencePieceProcessor(model_proto=model)
        self.end = self.processor.eos_id()
        self.size = self.processor.get_piece_size()

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The encoder puts a space in front: take it away where a unit has it, and its token where not.
        spaced = [u[:1] == SPACE for u in units]
        lists = self.processor.encode([u[1:] if s else u for u, s in zip(units, spaced)], num_threads=1)
        alone = [self.single[SPACE]] if SPACE in self.single else super().encode_units([SPACE])[0].tolist()
        lists = [(ids or alone) if s else ids[1:] for ids, s in zip(lists, spaced)]
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1])), ends

    def counts(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(len, self.encode(texts)), np.int64, len(texts))


_LOADED: dict[bytes, Tokenizer] = {}


def loaded(model: bytes) -> Tokenizer:
    """The tokenizer of these model bytes; a Python worker builds it once."""
    if model not in _LOADED:
        _LOADED[model] = Tokenizer(model)
    return _LOADED[model]
