"""Vector best-fit packing of tokenised documents into sequences (operator 9, Arrow tasks).

A document's ids are those of the tokenizer and one end id. Documents longer than a sequence are cut into full pieces and
a rest; nothing else is cut. A piece is a vector of demands (tokens, one document, the square of its length as attention
cost), a sequence a vector of capacities. Pieces are taken longest first, and each goes to the open sequence that meets
every constraint and whose weighted residual has the smallest norm ("norm"), or the largest weighted dot product with the
demands ("dot"). Pieces are dealt by hash into parts of about ``part_rows``, which are packed at the same time; a part
leaves at most a few sequences half empty. Only pieces are shuffled, never texts.

Cases: a null or empty text is its end id alone. Rows that repeat a doc_id are documents of their own. An empty table
gives no rows. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlens.llm.arrays import text_blocks
from ledgerlens.llm.words import ascii_lower, cut_words, word_bytes
from ledgerlens.session import stage

CAPACITY = 4096
END_ID = 1
PART_ROWS = 8000
# No piece is compared with more than the open sequences of this many pieces, whatever the part holds.
MOST_AT_ONCE = 32_000
# White space never lies within a token, so blank-separated words are encoded by themselves and remembered.
SPACE = b" \t\n\r\f\v"
# A run of marks (ASCII, neither letter nor digit) that ends a word is a unit of its own behind a letter or digit, so a cut in
# front of it changes nothing. Beyond ASCII the letters from U+00C0 to U+00FF are known, all but the two signs among them.
LATIN_LEAD, LATIN_SIGNS = 0xC3, (0x97, 0xB7)
BLOCK_BYTES, REMEMBERED_WORDS, REMEMBERED_BYTES = 4_000_000, 600_000, 20_000_000


def byte_strings(column: pa.Array) -> list[bytes]:
    """The values of a large binary column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    whole = data.to_pybytes() if data is not None else b""
    return [whole[a:b] for a, b in zip(at, at[1:])]


class WordIds:
    """Ids of texts, through a bounded memory of words whose ids lie in one array.

    The tokenizer lowers letters, which is done for A to Z beforehand. The words of a block of texts are cut and told apart as
    Arrow columns, and the ids of all its texts are gathered at once. New words are encoded together: a word of letters is one
    unit of the tokenizer, whose last token alone ends in the mark of a word's end, so the ids of many can be told apart.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.space, self.plain = np.zeros(256, bool), word_bytes()
        self.space[list(SPACE)] = True
        self.latin = np.zeros(256, bool)
        self.latin[128:192] = True
        self.latin[list(LATIN_SIGNS)] = False
        self.mark = np.zeros(256, bool)
        self.mark[33:127] = ~self.plain[33:127]
        self.plain[128:] = False
        self.lower = ascii_lower()
        self.forget()

    def forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.size, self.ids_of, self.used = 0, np.zeros(1 << 16, np.uint32), 0
        self.at = np.zeros(1 << 14, np.int64)  # where the ids of each word begin and those of the last end

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def remember(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Add words, given all their ids behind one another and where those of each end."""
        n, more = len(self.words), len(words)
        while len(self.ids_of) < self.used + len(ids):
            self.ids_of = np.concatenate([self.ids_of, np.zeros_like(self.ids_of)])
        while len(self.at) < n + more + 1:
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.ids_of[self.used : self.used + len(ids)] = ids
        self.at[n + 1 : n + more + 1] = self.used + ends
        self.words.update(zip(words, range(n, n + more)))
        self.used += len(ids)
        self.size += sum(map(len, words))

    def learn(self, new: list[bytes]) -> None:
        texts = [w.decode() for w in new]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        rest = [i for i, t in enumerate(texts) if not t.isalpha()]
        for at in range(0, len(plain), 500):
            part = plain[at : at + 500]
            ids = self.ids(" ".join([texts[i] for i in part]))
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(part):
                self.remember([new[i] for i in part], ids, last + 1)
            else:  # a letter that normalises to more than letters
                rest += part
        if rest:
            ids = [self.ids(texts[i]) for i in rest]
            self.remember([new[i] for i in rest], np.concatenate(ids), np.cumsum([len(x) for x in ids]))

    def closing(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where marks that close a word begin."""
        mark = self.mark[raw]
        first, last = mark.copy(), mark.copy()
        first[1:] &= ~mark[:-1]
        last[:-1] &= ~mark[1:]
        inner = at[(at > 0) & (at < len(raw))]
        first[inner], last[inner - 1] = mark[inner], mark[inner - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last)
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        latin = self.latin[raw[start - 1]] & (raw[start - 2] == LATIN_LEAD)
        behind = (self.plain[raw[start - 1]] | latin) & ~edge[start]
        before = edge[end + 1] | self.space[raw[np.minimum(end + 1, len(raw) - 1)]]
        begins = np.zeros(len(raw), bool)
        begins[start[behind & before]] = True
        return begins

    def of(self, column: pa.Array):
        """The ids of each text of a column, in order."""
        for first, last, raw, at in text_blocks(column, BLOCK_BYTES):
            # Special tokens are told from plain text by their case, so a text that may hold one is encoded as it is.
            opened = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))
            special = set((np.searchsorted(at, opened, "right") - 1).tolist())
            words, begins = cut_words(raw, at, ~self.space[raw], self.closing(raw, at), self.lower)
            coded = words.dictionary_encode()
            distinct = byte_strings(coded.dictionary)
            self.learn([w for w in distinct if w not in self.words])
            number = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
            start = self.at[number]
            size = self.at[number + 1] - start
            ends = np.zeros(len(number) + 1, np.int64)
            np.cumsum(size, out=ends[1:])
            ids = self.ids_of[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
            bounds = ends[begins]
            for row in range(last - first):
                yield self.ids(column[first + row].as_py()) if row in special else ids[bounds[row] : bounds[row + 1]]
            if len(self.words) > REMEMBERED_WORDS or self.size > REMEMBERED_BYTES:
                self.forget()


def pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document."""
    numbers = ["piece", "start", "length", "ids_crc32"]
    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType)] + [StructField(n, LongType()) for n in numbers])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        words = WordIds(tokenizer_file)
        for batch in batches:
            rows, out = [], []
            for row, own in enumerate(words.of(batch.column(1))):
                ids = memoryview(own.astype("<u4").tobytes() + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    out.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array([o[i] for o in out], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *numbers])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, schema)


def fit_vectors(
    lengths: np.ndarray, capacities: tuple[float, float, float], weights: tuple[float, float, float], rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``lengths`` must not rise."""
    limit, weight = np.array(capacities, float), np.array(weights, float)
    n = len(lengths)
    left = np.empty((3, n))  # of the open sequences, in columns
    name, opened, total = np.empty(n, np.int64), 0, 0
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    least = float(lengths[-1]) if n else 0.0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) ** 2])
        rest = left[:, :opened] - need[:, None]
        fits = np.flatnonzero((rest >= 0).all(axis=0))
        if len(fits):
            if rule == "norm":
                scaled = rest[:, fits] / limit[:, None]
                best = int(fits[np.argmin(weight @ (scaled * scaled))])
            else:
                best = int(fits[np.argmax((weight * need / limit**2) @ left[:, fits])])
        else:
            best, opened = opened, opened + 1
            left[:, best], name[best], total = limit, total, total + 1
        where[i], offset[i] = name[best], int(limit[0] - left[0, best])
        left[:, best] -= need
        if left[0, best] < least or left[1, best] < 1:  # full: the last open one takes its column
            opened -= 1
            left[:, best], name[best] = left[:, opened], name[opened]
    return where, offset


def pack(
    cut: DataFrame,
    capacity: int = CAPACITY,
    most_documents: int | None = None,
    attention_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``cut`` with sequence_id and offset. Without the second and third capacity they are as wide as the first allows:
    as many documents as tokens, and the cost of one full piece."""
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    cost = float(capacity) ** 2 if attention_cost is None else attention_cost
    if cost < float(capacity) ** 2:
        raise ValueError("attention_cost must hold a piece of full length")
    limits = (float(capacity), float(most_documents or capacity), cost)
    cut = stage(cut, "pieces")
    parts = max(1, -(-cut.count() // part_rows))
    schema = StructType(cut.schema.fields + [StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def fit(batches):
        part, base = TaskContext.get().partitionId(), 0

        def packed(rows: pa.Table):
            rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
            where, offset = fit_vectors(rows["length"].to_numpy(), limits, weights, rule)
            ids = pa.array(where + (part << 40) + base)
            yield from rows.append_column("sequence_id", ids).append_column("offset", pa.array(offset)).to_batches()

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= MOST_AT_ONCE:
                yield from packed(pa.Table.from_batches(held))
                held, base, rows = [], base + rows, 0
        if rows:
            yield from packed(pa.Table.from_batches(held))

    dealt = cut.repartition(parts, F.xxhash64("doc_id", "piece", "ids_crc32")).sortWithinPartitions("doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(fit, schema)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, **options) -> DataFrame:
    """The pieces of ``docs`` and their places."""
    return pack(pieces(docs, tokenizer_file, capacity, end_id), capacity, **options)
