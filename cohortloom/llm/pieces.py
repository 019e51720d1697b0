"""SentencePiece encoding and decoding on a relational lattice.

Texts are cut into words, a chunk of documents at a time.  The substrings of
every distinct word, up to the longest piece, are joined with the piece table;
the hits are the edges of the word's lattice.  The lattices are folded, those of
many words together: for scored models (unigram) by Viterbi, for merge models
(BPE) by taking the edges in merge order.  The ids of the words go to all places
of the chunk that hold them.  All of it works on arrays and stays in the
partition the documents are in; nothing is shuffled.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # below the worst score, for a character no piece covers (scored models)
NO_CHARACTER = 0x110000
PLACE_BITS = 18  # of a join key, for the table of places that keys of pieces have
GROUP_CHARACTERS = 1 << 17  # of words that are joined and folded together; a longer word is alone
CHUNK_BYTES = 4 << 20  # of text whose distinct words are encoded together; a longer text is alone
CHUNK_IDS = 1 << 18  # that are decoded together; a longer row is alone
FEW_WORDS = 32  # with fewer, their edges are folded one by one


@dataclass(frozen=True)
class Vocabulary:
    """The pieces of a model: text, id, score; the ids of the 256 bytes; whether pieces are made by merges."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    unknown: int
    merges: bool
    late: tuple[str, ...] = ()  # pieces that become possible after their turn in merge order

    def __post_init__(self):
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces):
            raise ValueError("a piece spans words")

    def alone(self) -> list[int]:
        """The control characters no longer piece holds; each is a word of its own."""
        inside = set("".join(p for p in self.pieces if len(p) > 1))
        return [c for c in range(32) if chr(c) not in inside]


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """The pieces of a BPE or unigram model file; the public 32,000-piece BPE model without a path."""
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    count = range(model.get_piece_size())
    plain = [i for i in count if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    by_bytes = tuple(i for i in count if model.is_byte(i))
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
    kinds = sentencepiece_model_pb2.TrainerSpec
    kind = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).trainer_spec.model_type
    if kind == kinds.UNIGRAM:
        return Vocabulary(pieces, by_bytes, model.unk_id(), False)
    if kind != kinds.BPE:
        raise ValueError("neither a BPE nor a unigram model")
    late = irregular_pieces(pieces)
    if irregular_pieces(pieces, late) or any(p != q and p in q for p in late for q in late):
        raise ValueError("some pieces are not made by merges in score order")
    return Vocabulary(pieces, by_bytes, model.unk_id(), True, late)


def merge_once(word: str, pieces: dict[str, tuple[int, float]], late: tuple[str, ...] = ()) -> list[int]:
    """Ends of the parts after one pass over the word's lattice in merge order (the fold, for one word in Python)."""
    edges = sorted(
        (-pieces[word[s:e]][1], s, e) for s in range(len(word)) for e in range(s + 2, len(word) + 1) if word[s:e] in pieces
    )
    cut = [True] * (len(word) + 1)

    def merge(s: int, e: int) -> bool:
        fits = s >= 0 and e <= len(word) and cut[s] and cut[e] and sum(cut[s + 1 : e]) == 1
        if fits:
            cut[s + 1 : e] = [False] * (e - s - 1)
        return fits

    for cost, s, e in edges:
        if merge(s, e):
            for p in late:
                if -pieces[p][1] <= cost:
                    for a in (e - len(p), s):
                        if word[max(a, 0) : a + len(p)] == p:
                            merge(a, a + len(p))
    return [i for i in range(1, len(word) + 1) if cut[i]]


def irregular_pieces(pieces: dict[str, tuple[int, float]], late: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Pieces that one pass in merge order does not make of their own characters.

    Without any, one pass equals repeated merging on every word: were a merge to
    become possible only after its turn, the piece it makes would be missed in
    the same way on its own characters.  ``late`` pieces are made as soon as
    their parts are, ahead of their turn.
    """
    return tuple(p for p in pieces if len(p) > 1 and merge_once(p, pieces, late) != [len(p)])


class PieceTable:
    """The pieces of a vocabulary as a table of arrays, to be joined with the substrings of many words at once.

    ``order`` numbers the pieces by cost, then length.  For every length there
    are the join keys of its pieces in rising order, their characters and their
    numbers, and the places that the top bits of a key can have.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.merges, self.unknown = vocabulary.merges, vocabulary.unknown
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        self.by_char = np.full(NO_CHARACTER + 1, -1, np.int32)
        for p, (i, _) in vocabulary.pieces.items():
            if len(p) == 1:
                self.by_char[ord(p)] = i
        shortest = 2 if vocabulary.merges else 1
        rows = sorted((-score, len(p), i, p) for p, (i, score) in vocabulary.pieces.items() if len(p) >= shortest)
        self.cost = np.array([r[0] for r in rows], np.float64)
        self.length = np.array([r[1] for r in rows], np.int64)
        self.id = np.array([r[2] for r in rows], np.int32)
        _, self.first, self.rank = np.unique(self.cost, return_index=True, return_inverse=True)
        self.late = [next(k for k, r in enumerate(rows) if r[3] == p) for p in vocabulary.late]
        worst = max((-score for _, score in vocabulary.pieces.values()), default=0.0)
        self.unknown_cost = worst + UNKNOWN_PENALTY
        longest = max((r[1] for r in rows), default=0)
        codes = {n: np.array([[ord(c) for c in r[3]] for r in rows if r[1] == n], np.uint64) for n in sorted({r[1] for r in rows})}
        for seed in itertools.count():
            self.weights = np.random.default_rng(seed).integers(1, 2**63, longest, np.uint64) * np.uint64(2) + np.uint64(1)
            keys = {n: (c * self.weights[:n]).sum(axis=1, dtype=np.uint64) for n, c in codes.items()}
            if all(len(np.unique(k)) == len(k) for k in keys.values()):
                break
        self.by_length = {}
        for n, k in keys.items():
            by_key = np.argsort(k)
            places = np.zeros(1 << PLACE_BITS, bool)
            places[(k >> np.uint64(64 - PLACE_BITS)).view(np.int64)] = True
            self.by_length[n] = (k[by_key], codes[n][by_key].astype(np.uint32), np.flatnonzero(self.length == n)[by_key], places)

    def join(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, order) of all substrings of a row of characters that are pieces: an equi-join on a key, then on the characters."""
        wide = codes.astype(np.uint64)
        key, starts, orders = np.zeros(len(codes), np.uint64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n in range(1, min(len(self.weights), len(codes)) + 1):
            key = key[: len(codes) - n + 1] + wide[n - 1 :] * self.weights[n - 1]
            if n not in self.by_length:
                continue
            keys, characters, order, places = self.by_length[n]
            start = np.flatnonzero(places[(key >> np.uint64(64 - PLACE_BITS)).view(np.int64)])
            found = key[start]
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            same = keys[at] == found
            start, at = start[same], at[same]
            same = np.ones(len(start), bool)
            for k in range(n):
                same &= codes[start + k] == characters[at, k]
            starts.append(start[same])
            orders.append(order[at[same]])
        return np.concatenate(starts), np.concatenate(orders)


@dataclass(frozen=True)
class Words:
    """Characters of words, each word followed by one place that holds none; word i begins at begin[i] and ends at begin[i + 1] - 1."""

    codes: np.ndarray
    begin: np.ndarray

    @staticmethod
    def of(words: pa.Array, blank: str = SPACE) -> Iterator[Words]:
        """The words in groups of about GROUP_CHARACTERS; ``blank`` is the character that stands for a marked blank."""
        words = _sound(words.cast(pa.large_string()))
        ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < len(words):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + GROUP_CHARACTERS, "right")))
            begin = np.concatenate([[0], ends[at:to] - before])
            _, offsets, data = words.buffers()
            span = np.frombuffer(offsets, np.int64, to - at + 1, 8 * (words.offset + at))
            text = bytes(memoryview(data)[span[0] : span[-1]]) if data is not None else b""
            codes = np.full(begin[-1], NO_CHARACTER, np.uint32)
            filled = np.ones(begin[-1], bool)
            filled[begin[1:] - 1] = False
            codes[filled] = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), "<u4")
            if blank != SPACE:
                codes[codes == ord(blank)] = ord(SPACE)
            yield Words(codes, begin)
            at = to

    def word_at(self) -> np.ndarray:
        """The number of the word at every place."""
        return np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))


def lattice(words: Words, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """(start, order) of the edges of the words' lattices: the substrings that are pieces, of two or more characters in merge models.

    Merge models: by word, cheapest first, then by start and length.  Scored
    models: by end, then by start.
    """
    start, order = table.join(words.codes)
    if not table.merges:
        by_end = np.lexsort((start, start + table.length[order]))
        return start[by_end], order[by_end]
    word = words.word_at()[start]
    rank, inside = table.rank[order], start - words.begin[word]
    tie = order - table.first[rank]
    width = [int(x.max(initial=0)).bit_length() for x in (rank, inside, tie)]
    if len(words.begin).bit_length() + sum(width) > 63:
        sort = np.lexsort((tie, inside, rank, word))
        return start[sort], order[sort]
    rank_bits, inside_bits, tie_bits = width
    packed = np.sort((((word << rank_bits | rank) << inside_bits | inside) << tie_bits) | tie)
    tie = packed & ((1 << tie_bits) - 1)
    packed >>= tie_bits
    inside = packed & ((1 << inside_bits) - 1)
    packed >>= inside_bits
    return words.begin[packed >> rank_bits] + inside, table.first[packed & ((1 << rank_bits) - 1)] + tie


def _turns(turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows by their turn, in the order they come within it, and where the turns begin."""
    most = int(turn.max(initial=-1))
    sort = np.argsort(turn.astype(np.uint16) if most < 1 << 16 else turn, kind="stable")
    return sort, np.concatenate([[0], np.cumsum(np.bincount(turn, minlength=most + 1))])


def _merge_fold(words: Words, start: np.ndarray, order: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """(begins, via): where parts begin, and the piece that ends at a place, or -1.

    The k-th edges of all words take their turn together; an edge is taken if it
    spans exactly two parts.  A late piece that a new part completes follows at
    once, the leftmost first.
    """
    size = len(words.codes)
    end = start + table.length[order]
    after = np.arange(1, size + 2)  # where the part that begins here ends; ``size`` where none begins
    after[size] = -1
    via = np.full(size, -1, np.int64)

    def merge(s, e, piece):
        fits = after[after[s]] == e
        s, e, piece = s[fits], e[fits], piece[fits]
        after[after[s]] = size
        after[s] = e
        via[e] = piece
        return s, e, piece

    late = []  # number, length and places of the late pieces that there are
    for k in table.late:
        if (here := start[order == k]).size:
            places = np.zeros(size, bool)
            places[here] = True
            late.append((k, int(table.length[k]), places))

    def turn(s, e, piece):
        s, e, piece = merge(s, e, piece)
        for k, n, places in late if s.size else ():
            dear = table.rank[piece] >= table.rank[k]
            for a in (e - n, s):
                a = a[dear & (a >= 0) & places[np.maximum(a, 0)]]
                merge(a, a + n, np.full(len(a), k))

    word = words.word_at()[start]
    count = np.bincount(word, minlength=len(words.begin) - 1)
    place = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
    sort, bounds = _turns(place)
    s, e, piece, done = start[sort], end[sort], order[sort], 0
    while done < len(bounds) - 1 and bounds[done + 1] - bounds[done] >= FEW_WORDS:
        these = slice(bounds[done], bounds[done + 1])
        turn(s[these], e[these], piece[these])
        done += 1
    rest = np.flatnonzero(place >= done)  # of a few words with many edges: one edge at a time
    to, ends_by = memoryview(after), memoryview(via)

    def merge_one(a, b, k):
        fits = to[to[a]] == b
        if fits:
            to[to[a]] = size
            to[a] = b
            ends_by[b] = k
        return fits

    late = [(k, n, int(table.rank[k]), memoryview(places)) for k, n, places in late]
    for a, b, k, rank in zip(*(x.tolist() for x in (start[rest], end[rest], order[rest], table.rank[order[rest]]))):
        if merge_one(a, b, k):
            for q, n, least, places in late:
                for c in (b - n, a):
                    if rank >= least and c >= 0 and places[c]:
                        merge_one(c, c + n, q)
    begins = after[:size] != size
    begins[words.begin[1:] - 1] = False
    return begins, via


def _viterbi_fold(words: Words, start: np.ndarray, order: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """As _merge_fold, for the path of least cost; of equal paths the one whose last piece begins first.

    The places with the same distance from their word's begin take their turn together.
    """
    size = len(words.codes)
    first = words.begin[:-1]
    length = np.diff(words.begin) - 1
    least, back, via = np.zeros(size), np.zeros(size, np.int64), np.full(size, -1, np.int64)
    end = start + table.length[order]
    sort, bounds = _turns(end - words.begin[words.word_at()[start]])
    start, order, end, cost = start[sort], order[sort], end[sort], table.cost[order[sort]]
    longest_first = np.argsort(-length, kind="stable")
    active = np.searchsorted(-length[longest_first], -np.arange(int(length.max(initial=0)) + 1), "right")
    for k in range(1, len(active)):
        here = first[longest_first[: active[k]]] + k
        least[here] = least[here - 1] + table.unknown_cost
        back[here] = here - 1
        if k + 1 >= len(bounds) or bounds[k] == bounds[k + 1]:
            continue
        s, e, piece = (x[bounds[k] : bounds[k + 1]] for x in (start, end, order))
        reached = least[s] + cost[bounds[k] : bounds[k + 1]]
        ends = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        best = np.repeat(np.minimum.reduceat(reached, ends), np.diff(np.concatenate([ends, [len(e)]])))
        nearest = np.where(reached == best, np.arange(len(e)), len(e))  # rows of an end come by their start
        chosen = np.minimum.reduceat(nearest, ends)
        chosen = chosen[reached[chosen] <= least[e[chosen]]]
        least[e[chosen]], back[e[chosen]], via[e[chosen]] = reached[chosen], s[chosen], piece[chosen]
    begins = np.zeros(size, bool)
    at, stop = (first + length)[length > 0], first[length > 0]
    while at.size:
        at = back[at]
        begins[at] = True
        at, stop = at[at > stop], stop[at > stop]
    return begins, via


def fold(words: Words, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """(begins, via) of the words' parts, from their lattice: in merge order, or of the path of least cost."""
    return (_merge_fold if table.merges else _viterbi_fold)(words, *lattice(words, table), table)


def ids_of_parts(words: Words, begins: np.ndarray, via: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes): the ids of all words in a row, and how many each word has; what is no piece goes by its bytes, or is unknown."""
    cut = begins.copy()
    cut[words.begin[1:] - 1] = True
    places = np.flatnonzero(cut)
    at = np.flatnonzero(begins[places])  # a part ends where the next part begins, or its word ends
    piece, code = via[places[at + 1]], words.codes[places[at]]
    one = table.by_char[code]
    ids = np.where(piece >= 0, table.id[piece], one) if len(table.id) else one
    sizes = np.ones(len(ids), np.int64)
    strange = np.flatnonzero(ids < 0)
    if strange.size and not len(table.byte_ids):
        ids[strange] = table.unknown
    elif strange.size:
        codes, which = np.unique(code[strange], return_inverse=True)
        spelt = [chr(c).encode("utf-8", "replace") for c in codes.tolist()]
        sizes[strange] = np.array([len(x) for x in spelt])[which]
        begin = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int32)
        out[begin] = ids
        for k in range(4):
            long = sizes[strange] > k
            out[begin[strange[long]] + k] = table.byte_ids[np.array([x[k] if k < len(x) else 0 for x in spelt])[which[long]]]
        ids = out
    total = np.concatenate([[0], np.cumsum(sizes)])
    return ids.astype(np.int32, copy=False), np.diff(total[np.searchsorted(places[at], words.begin)])


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, cuts) for a table of distinct, non-empty words; a 1 in cuts marks an end of a piece."""
    sent = words.sparkSession.sparkContext.broadcast(PieceTable(vocabulary))

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, word = 0, batch.column(0)
            for group in Words.of(word):
                begins, _ = fold(group, sent.value)
                begins[group.begin[1:] - 1] = True
                marks = pa.LargeStringArray.from_buffers(len(group.begin) - 1, pa.py_buffer(group.begin), pa.py_buffer(begins.astype(np.uint8) + ord("0")))
                yield pa.RecordBatch.from_arrays([word.slice(at, len(marks)), marks.cast(word.type)], ["word", "cuts"])
                at += len(marks)

    return words.select("word").mapInArrow(cuts, "word string, cuts string")


def _sound(texts: pa.Array, surrogates: bool = False) -> pa.Array:
    """The texts as UTF-8; bytes that are none become replacement characters, three for a surrogate or, if asked for, one as in Spark."""
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        raw = texts.cast(pa.large_binary()).to_pylist()
        if surrogates:
            raw = [None if x is None else re.sub(rb"\xed[\xa0-\xbf][\x80-\xbf]", b"\xef\xbf\xbd", x) for x in raw]
        return pa.array([None if x is None else x.decode("utf-8", "replace") for x in raw], texts.type)


def words_of(texts: pa.Array, alone: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, first): the words of non-empty texts, each with a blank put in front, and the number of the first word of every text.

    A word is leading blanks with what follows; characters of ``alone`` (control
    characters no longer piece holds) stand alone.  Marked blanks are blanks.
    """
    put, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    texts = pc.binary_join_element_wise(put, pc.replace_substring(texts, SPACE, " "), nothing)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    blank = text == ord(" ")
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[offsets[:-1] - offsets[0]] = True
    control = np.flatnonzero(text < 32)
    control = control[alone[text[control]]]
    begins[control] = True
    begins[control[control + 1 < len(text)] + 1] = True
    at = np.flatnonzero(begins)
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(text))), pa.py_buffer(text))
    return words, np.searchsorted(at, offsets - offsets[0])


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text, ids) for every row of (doc_id, text); ids is an array of ints.

    Null and empty texts have no ids.  Whole texts of any length are encoded,
    repeated rows each.  Texts stay where they are: the distinct words of about
    CHUNK_BYTES of text at a time are joined with the piece table, which every
    task has, and folded, and their ids go to the places of the words.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(PieceTable(vocabulary))
    alone = np.zeros(32, bool)
    alone[vocabulary.alone()] = True

    def ids_of(texts: pa.Array) -> pa.Array:
        """The ids of texts without null."""
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        told = np.flatnonzero(size)
        if not len(told):
            return pa.array([[]] * len(texts), pa.list_(pa.int32()))
        words, first = words_of(texts if len(told) == len(texts) else texts.take(pa.array(told)), alone)
        numbered = words.dictionary_encode()
        folded = [ids_of_parts(group, *fold(group, sent.value), sent.value) for group in Words.of(numbered.dictionary, " ")]
        ends = 4 * np.concatenate([[0], np.cumsum(np.concatenate([sizes for _, sizes in folded]))])
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate([ids for ids, _ in folded]))]
        )
        _, offsets, data = packed.take(numbered.indices).buffers()
        counts = np.zeros(len(texts) + 1, np.int64)
        counts[told + 1] = np.diff(np.frombuffer(offsets, np.int64, len(words) + 1)[first]) // 4
        ids = pa.Array.from_buffers(pa.int32(), int(counts.sum()), [None, data])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), ids)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            bytes_to = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(bytes_to, (bytes_to[at - 1] if at else 0) + CHUNK_BYTES, "right")))
                doc_id, text = (c.slice(at, to - at) for c in batch.columns)
                text = _sound(text, surrogates=True)
                ids = ids_of(pc.fill_null(text, "").cast(pa.large_string()))
                yield pa.RecordBatch.from_arrays([doc_id, text, ids], ["doc_id", "text", "ids"])
                at = to

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(chunks, f"doc_id {id_type}, text string, ids array<int>")


def _bare(texts: pa.Array) -> pa.Array:
    """Texts without null, less the blank in front of those that begin with one."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    begins = np.flatnonzero(np.diff(offsets))
    begins = begins[text[offsets[begins]] == ord(" ")]
    kept, fewer = np.ones(len(text), bool), np.zeros(len(offsets), np.int64)
    kept[offsets[begins]] = False
    fewer[begins + 1] = 1
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - np.cumsum(fewer)), pa.py_buffer(text[kept]))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of the ids: pieces and bytes put together, marks turned to blanks, the blank put in front taken off.

    Null ids give null, no ids an empty text, ids that are no piece or byte give
    nothing; bytes that are no UTF-8 become replacement characters.
    """
    known = {i: p.encode("utf-8") for p, (i, _) in vocabulary.pieces.items()}
    known |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    known = [known.get(i, b"") for i in range(max(known, default=-1) + 2)]  # the last is none
    sent = encoded.sparkSession.sparkContext.broadcast(known)  # as large as the model

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        parts, out = pa.array(sent.value, pa.large_binary()), []
        column = column.cast(pa.large_list(column.type.value_type))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_IDS, "right")))
            some = column.slice(at, to - at)
            flat = pc.fill_null(some.flatten(), -1).to_numpy(zero_copy_only=False)
            joined = parts.take(pa.array(np.where((flat >= 0) & (flat < len(parts)), flat, len(parts) - 1)))
            _, offsets, data = joined.buffers()
            first = np.concatenate([[0], ends[at:to] - (ends[at - 1] if at else 0)])
            offsets = np.frombuffer(offsets, np.int64, len(joined) + 1, 8 * joined.offset)[first]
            text = _sound(pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(offsets), data if data is not None else pa.py_buffer(b"")))
            text = _bare(pc.replace_substring(text, SPACE, " "))
            out.append(pc.if_else(some.is_valid(), text, None).cast(pa.string()))
            at = to
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return encoded.withColumn(name, text_of(F.col(ids)))


@query("op1_sentencepiece")
def op1_sentencepiece(spark, sf):
    vocabulary = load_vocabulary()
    both = decode(encode(table(spark, sf, "documents").select("doc_id", "text"), vocabulary), vocabulary)
    same = F.coalesce(F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), SPACE, " "), F.lit(False))

    @F.arrow_udf("bigint")
    def checksum(ids: pa.Array) -> pa.Array:
        return pa.array([zlib.crc32(x.values.to_numpy().astype("<u4").tobytes()) for x in ids], pa.int64())

    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), checksum("ids").alias("ids_crc32"), same.alias("round_trip"))
