"""SentencePiece encoding and decoding by an Aho-Corasick Viterbi.

One Aho-Corasick automaton holds all text pieces of the model. A text is read
once; at each position the automaton's output links list every piece that
ends there, and each relaxes the best score of the position (forward Viterbi:
highest sum of piece scores; ties go to fewer pieces, then to the longer last
piece). A character that no piece spells becomes its UTF-8 byte pieces, with
a penalty below every piece score.

Spaces become word marks and one mark is put before the text, as the model's
settings say; nothing else is normalised, so decoding gives back the text.
No piece has a mark after another character, and none holds a line break
(checked when the model is loaded), so the best path never crosses the start
of a word or a line end: such units are encoded one by one, and repeated units
come from a two-generation cache of bounded size, as strings with one
character for an id, which join fast.

Defined results: a null text has null ids and decodes to null; an empty text
has no ids; texts of any length are read whole; repeated rows each get their
row; an empty table gives no rows; other columns than id and text are not
read. Ids that are no text or byte pieces decode to nothing, and bytes that
are not UTF-8 to the replacement character. A text that has word marks itself
decodes with spaces in their place, as with any SentencePiece model.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from giftlink.llm import common
from giftlink.llm.tasks import worker_state

MARK = "▁"
CUT = "\0"
CACHE_WORDS = 200_000
UNIT = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
BYTE_RUNS = re.compile("[\U000F0000-\U000F00FF]+")


def spell(ids) -> str:
    """Ids as a string, one character each (surrogates are left out)."""
    return "".join([chr(i if i < 0xD800 else i + 0x2000) for i in ids])


def spelled_ids(text: str):
    """The ids of such a string."""
    ids = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where(ids < 0xD800, ids, ids - 0x2000).astype("<i4")


class Pieces:
    """Pieces, scores and the automaton of a SentencePiece model."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.text, self.byte_of, self.byte_id = {}, {}, {}
        automaton, low = ahocorasick.Automaton(), 0.0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if MARK in piece.lstrip(MARK) or "\n" in piece or BYTE_RUNS.search(piece):
                    raise ValueError(f"piece {piece!r} crosses the start of a word or a line")
                score = sp.get_score(i)
                low = min(low, score)
                self.text[i] = piece
                automaton.add_word(piece, (len(piece), i, score))
        automaton.make_automaton()
        self.automaton, self.unknown_score = automaton, low - 10.0
        self.unknown_id = sp.unk_id()
        # what an id decodes to; a byte is a private character until the end
        self.shown = [self.text.get(i, "") for i in range(sp.get_piece_size())]
        for i, x in self.byte_of.items():
            self.shown[i] = chr(0xF0000 + x)
        self.new, self.old = {"": ""}, {}

    def viterbi(self, word: str) -> list:
        """Ids of one word (marks, then other characters)."""
        n = len(word)
        best, count, back = [0.0] + [None] * n, [0] * (n + 1), [None] * (n + 1)
        done = 0

        def unknown(upto):
            # positions that no piece reached: one unknown character each
            nonlocal done
            while done < upto:
                done += 1
                score = best[done - 1] + self.unknown_score
                if best[done] is None or score > best[done]:
                    best[done], count[done], back[done] = score, count[done - 1] + 1, (1, -1)

        for end, (length, i, score) in self.automaton.iter(word):
            if done < end:
                unknown(end)
            start = end + 1 - length
            s, c = best[start] + score, count[start] + 1
            b = best[end + 1]
            # longer pieces come first in the output links, so an equal score
            # with an equal count keeps the longer one
            if b is None or s > b or (s == b and c < count[end + 1]):
                best[end + 1], count[end + 1], back[end + 1] = s, c, (length, i)
        unknown(n)
        ids, at = [], n
        while at:
            length, i = back[at]
            if i >= 0:
                ids.append(i)
            elif self.byte_id:
                ids.extend(self.byte_id[x] for x in reversed(word[at - 1].encode("utf-8", "surrogatepass")))
            else:
                ids.append(self.unknown_id)
            at -= length
        ids.reverse()
        return ids

    def units(self, text: str) -> list:
        if "  " in text or text[0] == " " or MARK in text or CUT in text:
            return UNIT.findall(MARK + text.replace(" ", MARK))
        # the same, faster: no run of marks is longer than one
        return (MARK + text.replace(" ", CUT + MARK).replace("\n", CUT + "\n" + CUT)).split(CUT)

    def encode(self, text: str):
        """Ids of a text as a 32-bit array."""
        if not text:
            return np.zeros(0, "<i4")
        units = self.units(text)
        ids = list(map(self.new.get, units))
        if None in ids:
            fresh = {}
            for u in {u for u, x in zip(units, ids) if x is None}:
                known = self.old.get(u)
                fresh[u] = spell(self.viterbi(u)) if known is None else known
            ids = [fresh[u] if x is None else x for u, x in zip(units, ids)]
            if len(self.new) + len(fresh) > CACHE_WORDS:
                self.new, self.old = {"": ""}, self.new
            self.new.update((u, x) for u, x in fresh.items() if len(u) <= 64)
        return spelled_ids("".join(ids))

    def decode(self, ids) -> str:
        shown, n = self.shown, len(self.shown)
        if len(ids) and (ids.min() < 0 or ids.max() >= n):
            ids = ids[(ids >= 0) & (ids < n)]
        text = "".join(map(shown.__getitem__, ids.tolist()))
        if not text.isascii():
            text = BYTE_RUNS.sub(lambda m: bytes(ord(c) - 0xF0000 for c in m[0]).decode("utf-8", "replace"), text)
            text = text.replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def _model(docs: DataFrame, model_path: str | None):
    path = model_path or common.vocabulary("piece_bpe_32k.model")
    model = common.in_small_batches(docs).sparkSession.sparkContext.broadcast(common.file_bytes(path))
    return lambda: worker_state(("sentence_pieces", path), lambda: Pieces(model.value))


def encode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row."""
    pieces_of = _model(docs, model_path)

    def run(batches):
        pieces = pieces_of()
        for batch in batches:
            ids = [None if t is None else pieces.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, common.schema_of(docs, id_col, "ids array<int>"))


def _lists(column):
    """The rows of a list column as arrays (None for null)."""
    offsets = column.offsets.to_numpy()
    values = column.values.fill_null(-1).to_numpy(zero_copy_only=False)
    for ok, a, b in zip(column.is_valid().to_pylist(), offsets[:-1], offsets[1:]):
        yield values[a:b] if ok else None


def decode(encoded: DataFrame, model_path: str | None = None, keep: str = "doc_id,ids") -> DataFrame:
    """The columns ``keep`` (with ``ids``) and decoded string."""
    pieces_of = _model(encoded, model_path)
    names = keep.split(",")
    at = names.index("ids")

    def run(batches):
        pieces = pieces_of()
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in _lists(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, common.schema_of(encoded, keep, "decoded string"))


def round_trip(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, ids_le binary, decoded string) of every row: the ids as
    little-endian 32-bit integers, and what they decode to, in one pass."""
    pieces_of = _model(docs, model_path)

    def run(batches):
        pieces = pieces_of()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):  # bounds the ids held at once
                part = batch.slice(lo, 512)
                ids = [None if t is None else pieces.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([None if x is None else x.tobytes() for x in ids], pa.binary()),
                     pa.array([None if x is None else pieces.decode(x) for x in ids], pa.string())],
                    names=[id_col, "ids_le", "decoded"])

    return docs.select(id_col, text_col).mapInArrow(
        run, common.schema_of(docs, id_col, "ids_le binary, decoded string"))


common.ship(__name__)
