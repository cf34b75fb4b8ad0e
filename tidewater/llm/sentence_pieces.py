"""Encoding and decoding with merge-type SentencePiece vocabularies.

The text is normalised as the vocabulary says (spaces become U+2581, one is
put in front), split into symbols, and symbols are merged by an agenda:
a heap of adjacent symbol pairs that spell a piece, highest score first,
leftmost first among equals; each merge offers the two new pairs. Symbols
that are no piece fall back to their UTF-8 bytes.

A merge can only join two characters that stand side by side inside some
piece. Texts are therefore cut first where no piece has such a neighbour
pair, the agenda runs once per distinct fragment and worker, and a text is
the concatenation of its fragments. This is exact, and checked against the
library over whole tables in the tests and by ``check_with_library``: of every
Arrow batch, the fragments and the cuts (the two characters beside one) that the
worker has not compared yet go to the library, which must give the same ids and
decode them to the same text. A text is made of nothing else.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add, itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

SPACE = "▁"
#: Piece types in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Distinct fragments a worker remembers, and their longest; others are merged (and
#: compared) again when met.
REMEMBERED, LONGEST = 400_000, 64
#: What an unknown id decodes to where the model names nothing else.
UNKNOWN_TEXT = " ⁇ "
#: Stands for a control id while byte runs are read; no character of any text.
HALT = "\U0010FFFF"

FIRST, LAST = itemgetter(0), itemgetter(-1)
#: ASCII characters but letters and digits; a run of them may be one fragment.
MARK = re.compile(SPACE + r"*[\x00-\x1F!-/:-@\[-`{-\x7F]")

# one replacement character for each byte that is not valid UTF-8
codecs.register_error("replace_each_byte", lambda e: ("�", e.start + 1))


class Fragments(dict):
    """Fragment -> ids, filled by the agenda on first use."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge
        self.fresh: list[tuple] = []

    def __missing__(self, fragment):
        ids = self.merge(fragment)
        self.fresh.append((fragment, ids))
        if len(self) < REMEMBERED and len(fragment) <= LONGEST:
            self[fragment] = ids
        return ids


class MergeVocabulary:
    """Pieces, scores and normaliser flags of a model file of merge type.

    Raises ValueError for models that need more than this operator does:
    another type, a character map, white-space removal, user-defined or
    unused pieces.
    """

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only merge-type models without user-defined or unused pieces")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or \
                not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisation with escaped spaces in front of words")
        self.dummy_prefix = spec.add_dummy_prefix
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type != BYTE}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces)
                         if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.end = self.ids[model.trainer_spec.eos_piece]
        self.control = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.starts_with_space = {i for i, p in enumerate(model.pieces)
                                  if p.type == NORMAL and p.piece.startswith(SPACE)}
        surface = model.trainer_spec.unk_surface or UNKNOWN_TEXT
        # bytes from 0x80 travel as lone surrogates until whole runs are decoded
        self.surface = [
            "" if p.type == CONTROL else surface if p.type == UNKNOWN else
            (chr(b) if (b := int(p.piece[3:5], 16)) < 128 else chr(0xDC00 + b))
            if p.type == BYTE else p.piece.replace(SPACE, " ")
            for p in model.pieces]
        self.id_text = [str(i) for i in range(len(model.pieces))]
        self.cut = re.compile(self._cut_pattern())
        self.fragments = Fragments(self.merge)
        self.cuts: set[str] = set()

    def _cut_pattern(self) -> str:
        """Fragments end where no piece has the two neighbouring characters.

        Before a space mark; around ``apart``, ASCII marks and controls that
        pieces join with no character outside that set; and between a letter
        and an ``ending`` mark, which no piece has to the right of a letter.
        """
        pairs = {(a, b) for p in self.scores for a, b in zip(p, p[1:])}
        if any(b == SPACE and a != SPACE for a, b in pairs):
            return r"(?s).+"
        marks = {chr(c) for c in range(128) if not chr(c).isalnum()}
        apart = set(marks)
        while joined := {c for a, b in pairs if a != SPACE and (a in apart) != (b in apart)
                         for c in (a, b) if c in apart}:
            apart -= joined
        odd = {a for a, _ in pairs if a.isalnum() and not a.isalpha()}  # like superscripts
        letter = rf"[^\W\d_{''.join(sorted(odd))}]"
        ending = marks - apart - {b for a, b in pairs if re.match(letter, a)}

        def chars(*sets):
            return "".join(re.escape(c) for c in sorted(set().union(*sets)))

        no = "(?!)"  # matches nothing, for an empty set
        alone = rf"{SPACE}*[{chars(apart)}]+" if apart else no
        more = rf"|(?<!{letter})[{chars(ending)}]" if ending else ""
        return (rf"{alone}|{SPACE}*[^{SPACE}{chars(apart)}]"
                rf"(?:[^{SPACE}{chars(apart, ending)}]+{more})*|{SPACE}+")

    def merge(self, fragment: str) -> tuple[int, ...]:
        """Ids of one fragment: the agenda of adjacent pairs."""
        symbols = list(fragment)
        n = len(symbols)
        score_of = self.scores.get
        # scores fall with the rank of the merge: the heap holds their negatives
        agenda = [(-score, i, i + 1, joined)
                  for i, joined in enumerate(map(add, symbols, symbols[1:]))
                  if (score := score_of(joined)) is not None]
        heapify(agenda)
        before = list(range(-1, n - 1))
        after = list(range(1, n + 1))
        while agenda:
            _, left, right, joined = heappop(agenda)
            # stale when one side has been merged since the pair was offered
            if not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(joined) \
                    or not symbols[left]:
                continue
            symbols[left], symbols[right] = joined, ""
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                pair = joined + symbols[nxt]
                if (score := score_of(pair)) is not None:
                    heappush(agenda, (-score, left, nxt, pair))
            if (prev := before[left]) >= 0:
                pair = symbols[prev] + joined
                if (score := score_of(pair)) is not None:
                    heappush(agenda, (-score, prev, left, pair))
        ids = []
        for s in filter(None, symbols):
            if s in self.scores:
                ids.append(self.ids[s])
            elif self.byte_fallback:
                ids.extend(self.byte_ids[b] for b in s.encode("utf-8"))
            else:
                ids.append(self.unknown)
        return tuple(ids)

    def encode(self, text: str | None, proof: list[tuple] | None = None) -> list[int]:
        """Ids of the whole text and the end id; null counts as empty.

        ``proof`` gathers the fragments and cuts that are new here, with their ids.
        """
        if not text:
            return [self.end]
        text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        parts = self.cut.findall(text)
        ids = list(chain.from_iterable(map(self.fragments.__getitem__, parts)))
        if not self.byte_fallback:  # neighbouring unknown symbols are one unknown id
            ids = [i for k, i in enumerate(ids)
                   if i != self.unknown or k == 0 or ids[k - 1] != self.unknown]
        if proof is not None:
            beside = set(map(add, map(LAST, parts), map(FIRST, parts[1:])))
            if not beside <= self.cuts:
                for a, b in zip(parts, parts[1:]):
                    if a[-1] + b[0] not in self.cuts:
                        proof.append((a + b, self.fragments[a] + self.fragments[b]))
                        self.cuts.add(a[-1] + b[0])
            proof += self.fragments.fresh
            self.fragments.fresh.clear()
        ids.append(self.end)
        return ids

    def decode(self, ids) -> str:
        """Text of ids: control ids vanish, byte runs are read as UTF-8."""
        text = "".join(map(self.surface.__getitem__, ids))
        try:
            text.encode("utf-8")
        except UnicodeEncodeError:  # a control id ends a run of bytes
            parts = "".join(HALT if i in self.control else self.surface[i] for i in ids)
            text = parts.encode("utf-8", "surrogateescape").decode("utf-8", "replace_each_byte")
            text = text.replace(HALT, "")
        if self.dummy_prefix:
            first = next((i for i in ids if i not in self.control), None)
            if first in self.starts_with_space:
                text = text[1:]
        return text


@lru_cache(maxsize=4)
def vocabulary(model_file: str) -> MergeVocabulary:
    return MergeVocabulary(model_file)


@lru_cache(maxsize=4)
def library(model_file: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def forget() -> None:
    """Give back what tasks of this module left in the Python worker.

    Spark hands workers on to later stages: tasks of other operators call this before
    they fill a memory of their own, so that a worker holds one at a time.
    """
    if vocabulary.cache_info().currsize:
        vocabulary.cache_clear()
        library.cache_clear()
        gc.collect()  # a vocabulary and its fragments refer to each other


def compare(v: MergeVocabulary, model_file: str, proof: list[tuple]) -> None:
    """Raise where the library gives other ids for a text, or decodes them otherwise.

    ``proof``: texts with spaces as marks, and our ids. Those without an ASCII mark at
    their ends are compared in one text, cut apart by line ends.
    """
    words, alone = [], []
    for t, ids in proof:
        (alone if MARK.match(t) or MARK.match(t[-1]) else words).append((t, ids))
    texts = ["\n" + "\n".join(t for t, _ in words).replace(SPACE, " ")]
    line_end = v.merge("\n")
    ours = [[*v.encode("\n")[:-1], *chain.from_iterable(
        ids if k == 0 else line_end + ids for k, (_, ids) in enumerate(words)), v.end]]
    for t, _ in alone:
        texts.append(t.replace(SPACE, " ").removeprefix(" " if v.dummy_prefix else ""))
        ours.append(v.encode(texts[-1]))
    lib = library(model_file)
    theirs = lib.encode(texts, add_eos=True, num_threads=1)
    if not v.byte_fallback:  # neighbouring unknown symbols need the whole text
        ours = [v.encode(t) for t in texts]
    for text, ids, want, back in zip(texts, ours, theirs, lib.decode(theirs, num_threads=1)):
        if ids != want:
            raise AssertionError(f"ids differ from the library's for {text[:200]!r}")
        if v.decode(ids) != back:
            raise AssertionError(f"the decoded text differs from the library's for {text[:200]!r}")
    v.fragments.fresh.clear()


def encode_texts(docs: DataFrame, model_file: str, *, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True,
                 with_text: bool = True, check_with_library: bool = False) -> DataFrame:
    """Encode whole texts, decode the ids again, and describe both.

    ``model_file`` must be readable under the same path on every worker (an
    installed package or a distributed file). Columns returned: ``keep``,
    then ``ids`` (array of int, end id last; left out with
    ``with_ids=False``), ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by one space), ``decoded`` (left out with ``with_text=False``) and
    ``decoded_sha256``. With ``check_with_library`` all that is new in an Arrow
    batch is also encoded and decoded by the sentencepiece library; a difference
    raises and ends the job, which is meant: no wrong id goes out unnoticed.

    Null and empty texts encode to the end id alone and decode to the empty
    text. Each input row gives one row, so repeated rows and null ids come
    back as they are; other columns of the input are not read. Memory per
    task: one Arrow batch plus REMEMBERED fragments.
    """
    bounded_batches(docs.sparkSession)
    kept = docs.select(*keep, F.col(text).alias("_text"))
    fields = [docs.schema[c] for c in keep]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType())]
    if with_text:
        fields.append(T.StructField("decoded", T.StringType()))
    fields.append(T.StructField("decoded_sha256", T.StringType()))
    n_keep = len(keep)

    def batches(it):
        v = vocabulary(model_file)
        for b in it:
            texts = b.column(n_keep).to_pylist()
            proof = [] if check_with_library else None
            ids = [v.encode(t, proof) for t in texts]
            if proof:
                compare(v, model_file, proof)
            v.fragments.fresh.clear()
            decoded = [v.decode(i) for i in ids]
            cols = [b.column(k) for k in range(n_keep)]
            names = list(keep)
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            cols.append(pa.array([len(i) for i in ids], pa.int64()))
            text_of = v.id_text.__getitem__
            cols.append(pa.array([hashlib.sha256(" ".join(map(text_of, i)).encode()).hexdigest()
                                  for i in ids]))
            names += ["n_tokens", "ids_sha256"]
            if with_text:
                cols.append(pa.array(decoded, pa.string()))
                names.append("decoded")
            cols.append(pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]))
            names.append("decoded_sha256")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return kept.mapInArrow(batches, T.StructType(fields))


def decode_ids(df: DataFrame, model_file: str, *, ids: str = "ids",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded``: the text of an array-of-int column; null ids give null."""
    bounded_batches(df.sparkSession)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())])
    n_keep = len(keep)

    def batches(it):
        v = vocabulary(model_file)
        for b in it:
            texts = [None if i is None else v.decode(i) for i in b.column(n_keep).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(n_keep)] + [pa.array(texts, pa.string())],
                names=[*keep, "decoded"])

    return df.select(*keep, ids).mapInArrow(batches, schema)
