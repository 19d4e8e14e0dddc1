"""What the unigram operators share: the vocabulary of a SentencePiece file, and texts as units that no piece crosses.

The file's text rules are: a space put before the text, spaces written as U+2581, nothing else changed, characters that
no piece covers spelled as bytes. No piece has U+2581 after another character, and none holds a line end or a
tab, so a text falls into units (spaces and the characters after them; single line ends and tabs) and its best or
sampled segmentation is that of its units in a row. This is checked when the vocabulary is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from hourloom.llm import words

MARK = "▁"
UNITS = words.Scheme.of({10: 1, 9: 1, 32: 2}, {(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (3, 2)})
FIRST = words.scrambled(1, 60)[0]
#: Units whose results a worker remembers.
REMEMBER = 200_000


class Vocabulary:
    """Pieces and scores of a model file, with an Aho-Corasick automaton over the pieces."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.size = n
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {i: model.get_score(i) for i in plain}
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.byte_id) != 256 or model.normalize("a  ﬁ\n") != f"{MARK}a{MARK} ﬁ\n":
            raise ValueError("the model must spell unknown characters as bytes and leave texts as they are")
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            piece = self.pieces[i]
            if MARK in piece.lstrip(MARK) or "\n" in piece or "\t" in piece:
                raise ValueError(f"piece {piece!r} crosses the units of a text")
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        #: As in the tokenizer: below every piece.
        self.unknown = min(self.score.values()) - 10

    def spelled(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8")]


class UnitTable:
    """A learner's results by unit; each distinct unit is handled once.

    ``learn(unit)`` returns a tuple; its place in ``found`` is the unit's slot.
    """

    def __init__(self, learn):
        self.learn = learn
        self.slots: dict[int, int] = {}
        self.found: list = []

    def of(self, block: words.Block) -> np.ndarray:
        """The slot of every unit of the block."""
        if len(self.slots) > REMEMBER:
            self.slots, self.found = {}, []
        keys = block.hashes.copy()
        begin = np.cumsum(block.counts) - block.counts
        leading = np.zeros(len(keys), dtype=bool)
        leading[begin[block.counts > 0]] = True
        keys[leading] = words.mix(keys[leading] ^ FIRST)
        codes, distinct = pd.factorize(keys)
        first = np.empty(len(distinct), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        slots = self.slots
        out = np.empty(len(distinct), dtype=np.int64)
        for j, (key, at) in enumerate(zip(distinct.tolist(), first.tolist())):
            slot = slots.get(key)
            if slot is None:
                slot = slots[key] = len(self.found)
                unit = block.word(at).replace(" ", MARK)
                self.found.append(self.learn(MARK + unit if leading[at] else unit))
            out[j] = slot
        return out[codes]


def unit_blocks(column: pa.Array) -> Iterator[words.Block]:
    """Blocks of units. U+2581 in a text means a space, as to the tokenizer."""
    if pc.any(pc.match_substring(column, MARK)).as_py():
        column = pc.replace_substring(column, MARK, " ")
    return words.blocks(column, UNITS)
