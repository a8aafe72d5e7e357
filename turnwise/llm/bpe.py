"""Byte-level BPE: encoding by recursive DuckDB queries inside the tasks, decoding by ordered
aggregation.

A task splits its texts with the pattern of the vocabulary and sends each new distinct word
once to an in-process DuckDB. There a step lays every word out as one row per token position,
joins neighbouring tokens to the merge table and contracts, in every word, the leftmost pair
of lowest rank; words without such a pair leave the recursion. Decoding joins the ids to the
vocabulary and puts the bytes of a text together by an ordered aggregation. Words and their
ids are kept in arrays for the following batches, up to a fixed size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

# Bounds of memory, not of results: bytes of text at a time, words in one query, and pieces
# and their bytes in each of the two generations that are kept.
BYTES = 1_500_000
# Lists of ids that are decoded at a time.
ROWS = 500
WORDS_PER_QUERY = 12_000
PIECES_KEPT, BYTES_KEPT = 150_000, 6_000_000
# Words of more bytes are put together from blocks of this size.
BLOCK = 48
# What stays whole when a text is cut: letters, other marks, or marks up to an apostrophe and
# the letters behind it. White space goes to what follows.
UNITS = r"[^\s\p{L}]*'\p{L}+|\p{L}+|[^\s\p{L}]+"
# Latin, Greek and Cyrillic letters, general punctuation, kana and ideographs, but no rare
# white space: there every engine agrees on what is a letter and what is white space.
NOT_PLAIN = (
    r"[^\t\n\r -~\x{a1}-\x{24f}\x{391}-\x{3a1}\x{3a3}-\x{3c9}\x{400}-\x{481}\x{2010}-\x{2027}"
    r"\x{2030}-\x{205e}\x{3001}-\x{3020}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}]"
)
# Without spilling: a query that needs more memory than this is an error, not a local file.
DUCKDB = {"threads": 1, "memory_limit": "300MB", "temp_directory": "", "max_temp_directory_size": "0KB"}

_CONTRACT = """
WITH RECURSIVE step(w, ids, live) AS (
  SELECT w, ids, true FROM words
  UNION ALL
  SELECT s.w,
    CASE WHEN best IS NULL THEN ids ELSE list_concat(
      list_append(ids[:(best & 4294967295) - 1], (best >> 32)::INTEGER), ids[(best & 4294967295) + 2:]
    ) END,
    best IS NOT NULL
  FROM (SELECT w, ids FROM step WHERE live) s
  LEFT JOIN (
    SELECT w, min((merged << 32) | p) AS best
    FROM (
      SELECT w, (unnest(ids[:-2])::BIGINT << 32) | unnest(ids[2:]) AS pair, unnest(range(1, len(ids))) AS p
      FROM step WHERE live
    ) JOIN merges USING (pair)
    GROUP BY w
  ) b USING (w)
)
SELECT w, ids FROM step WHERE NOT live
"""

_DECODE = """
SELECT d, unhex(string_agg(hex, '' ORDER BY p)) AS bytes
FROM token_rows JOIN vocabulary USING (t) GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """(left, right, merged) ids of every way to put a token together from two."""
    for token, merged in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                yield left, right, merged


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Parts of an array end to end, without a loop."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat((starts - ends + lengths).astype(np.int32), lengths) + np.arange(ends[-1], dtype=np.int32)]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


class _Pieces:
    """Distinct pieces of texts and the ids of each, in arrays."""

    def __init__(self):
        import pyarrow as pa

        self.pieces = pa.array([], pa.large_string())
        self.flat, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def find(self, values) -> np.ndarray:
        """The place of each value, -1 where it is not here."""
        import pyarrow.compute as pc

        return pc.fill_null(pc.index_in(values, value_set=self.pieces), -1).to_numpy()

    def add(self, values, flat: np.ndarray, lengths: np.ndarray) -> None:
        import pyarrow as pa

        self.pieces = pa.concat_arrays([self.pieces, values])
        self.starts = np.concatenate([self.starts, len(self.flat) + _starts(lengths)]).astype(np.int32)
        self.lengths = np.concatenate([self.lengths, lengths]).astype(np.int32)
        self.flat = np.concatenate([self.flat, flat])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _gather(self.flat, self.starts[at], self.lengths[at]), self.lengths[at]

    def full(self) -> bool:
        return len(self.pieces) > PIECES_KEPT or self.pieces.nbytes > BYTES_KEPT


class Tokenizer:
    """The vocabulary, and the pieces of texts met lately with their ids.

    Pieces are kept in two generations. When the young one is full it becomes the old one,
    and what is met again moves back, so frequent pieces stay and rare ones go. DuckDB is
    there between ``open`` and ``close`` only.
    """

    def __init__(self, path: str, pattern: str):
        import pyarrow as pa
        import regex

        self.split = regex.compile(pattern)
        ranks = read_ranks(path)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = np.fromiter(chain.from_iterable(merge_table(ranks)), np.int64).reshape(-1, 3).T
        self.merges = pa.table({"pair": (left << 32) | right, "merged": merged})
        self.tokens = pa.array(list(ranks), pa.large_binary())
        self.token_ids = np.fromiter(ranks.values(), np.int32, len(ranks))
        self.young, self.old = _Pieces(), _Pieces()

    def open(self) -> None:
        import duckdb

        self.con = duckdb.connect(config=DUCKDB)
        self.load("merges", self.merges)
        self.decodes = False

    def close(self) -> None:
        self.con.close()

    def load(self, name: str, table) -> None:
        self.con.register("incoming", table)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def contract(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct words and their numbers, by the recursive query. ``words`` is
        an Arrow array of large binaries."""
        import pyarrow as pa

        flats, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for first in range(0, len(words), WORDS_PER_QUERY):
            some = words.slice(first, WORDS_PER_QUERY)
            ends = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + len(some) + 1]
            tokens = self.byte_ids[np.frombuffer(some.buffers()[2], np.uint8)[ends[0] : ends[-1]]]
            lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(tokens))
            self.load("words", pa.table({"w": np.arange(len(some), dtype=np.int32), "ids": lists}))
            found = self.con.sql(_CONTRACT).to_arrow_table().combine_chunks()
            ids = found["ids"].chunk(0)
            n = ids.value_lengths().to_numpy()
            order = np.argsort(found["w"].to_numpy())
            flats.append(_gather(ids.flatten().to_numpy(), _starts(n)[order], n[order]))
            lengths.append(n[order])
        return np.concatenate(flats), np.concatenate(lengths)

    def contract_long(self, words: list[bytes]) -> list[bytes]:
        """The ids, 32 bits each, of words of any length. They are put together from blocks,
        so that the work does not grow with the square of a word.

        Ids in a row are the encoding of their bytes exactly if the bytes of every two
        neighbours encode to these two: no merge can then cross from one to the next. Inside
        a block they do. So the pairs at the seams are looked at, and blocks at a seam that
        does not hold become one block, until all seams hold.
        """
        import pyarrow as pa

        def coded(distinct: list[bytes]) -> list[bytes]:
            flat, n = self.contract(pa.array(distinct, pa.large_binary()))
            data, ends = flat.tobytes(), (4 * np.cumsum(n)).tolist()
            return [data[a:b] for a, b in zip([0, *ends], ends)]

        blocks = [[w[i : i + BLOCK] for i in range(0, len(w), BLOCK)] for w in words]
        known: dict[bytes, bytes] = {}
        holds: dict[bytes, bool] = {}
        open_ = range(len(words))
        while open_:
            new = list({b for k in open_ for b in blocks[k]} - known.keys())
            known.update(zip(new, coded(new)))
            seams = [[known[a][-4:] + known[b][:4] for a, b in zip(blocks[k], blocks[k][1:])] for k in open_]
            unseen = list({s for word in seams for s in word} - holds.keys())
            pairs = [b"".join(self.bytes_of[i] for i in np.frombuffer(s, np.int32).tolist()) for s in unseen]
            distinct = list(set(pairs))
            as_one = dict(zip(distinct, coded(distinct)))
            holds.update((s, as_one[p] == s) for s, p in zip(unseen, pairs))
            again = []
            for k, word in zip(open_, seams):
                joined, grown = [blocks[k][0]], False
                for seam, block in zip(word, blocks[k][1:]):
                    # A block that has just grown waits for its new ids.
                    if not holds[seam] and not grown:
                        joined[-1] += block
                        grown = True
                    else:
                        joined.append(block)
                        grown = False
                if len(joined) < len(blocks[k]):
                    again.append(k)
                blocks[k] = joined
            open_ = again
        return [b"".join(known[b] for b in word) for word in blocks]

    def code(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, starts, lengths) of the ids of distinct words: one id for a word that is a
        token, else contracted."""
        import pyarrow as pa
        import pyarrow.compute as pc

        data = words.cast(pa.large_binary())
        token = pc.fill_null(pc.index_in(data, value_set=self.tokens), -1).to_numpy()
        size = pc.binary_length(data).to_numpy()
        whole, short = token >= 0, (token < 0) & (size <= BLOCK)
        long = (token < 0) & (size > BLOCK)
        flat, n = self.contract(data.filter(pa.array(short)))
        more = self.contract_long(data.filter(pa.array(long)).to_pylist())
        lengths = np.ones(len(words), np.int64)
        lengths[short], lengths[long] = n, [len(m) // 4 for m in more]
        order = np.concatenate([np.flatnonzero(k) for k in (whole, short, long)])
        starts = np.empty(len(words), np.int64)
        starts[order] = _starts(lengths[order])
        return np.concatenate([self.token_ids[token[whole]], flat, np.frombuffer(b"".join(more), np.int32)]), starts, lengths

    def learn(self, new) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Works out pieces that are in neither generation: the order in which they come, flat
        ids and their numbers. Most pieces are one word of letters; the others are split."""
        import pyarrow as pa
        import pyarrow.compute as pc

        single = pc.and_(
            pc.match_substring_regex(new, r"^ ?\p{L}+$"), pc.invert(pc.match_substring_regex(new, NOT_PLAIN))
        )
        letters = new.filter(single)
        split = [self.split.findall(p) for p in new.filter(pc.invert(single)).to_pylist()]
        words = pa.concat_arrays([letters, pa.array([w for some in split for w in some], pa.large_string())])
        words = words.dictionary_encode()
        flat, starts, lengths = self.code(words.dictionary)
        index = words.indices.to_numpy()
        per_word = lengths[index]
        # Words of each piece, and from them its ids.
        count = np.concatenate([np.ones(len(letters), np.int64), np.array([len(s) for s in split], np.int64)])
        total = np.concatenate([[0], np.cumsum(per_word)])
        ends = np.cumsum(count)
        chosen = single.to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(chosen), np.flatnonzero(~chosen)])
        return order, _gather(flat, starts[index], per_word), total[ends] - total[ends - count]

    def cut(self, texts):
        """Texts as lists of pieces that split independently, as an Arrow list array.

        A match of the pattern holds white space at its start alone, and letters are followed
        by letters only. So a text may be cut after any run of letters, and after any run of
        other marks but an apostrophe before letters. Texts with characters on whose class
        the two regular expression engines might differ are split by the pattern itself.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, NOT_PLAIN)
        others = texts.filter(odd).to_pylist()
        mark = next(m for m in map(chr, range(0xE000, 0xF900)) if not any(m in t for t in others))
        marked = pc.replace_substring_regex(texts, UNITS, "\\0" + mark)
        if others:
            split = pa.array([mark.join(self.split.findall(t)) for t in others], pa.large_string())
            marked = pc.replace_with_mask(marked, odd, split)
        return pc.split_pattern(marked, mark)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number per text, of an Arrow array of texts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.young.full():
            self.young, self.old = _Pieces(), self.young
        cut = self.cut(texts)
        pieces = pc.list_flatten(cut).dictionary_encode()
        at = self.young.find(pieces.dictionary).copy()
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lost = pieces.dictionary.take(pa.array(missing))
            back = self.old.find(lost)
            there = back >= 0
            new = lost.filter(pa.array(~there))
            order, flat, lengths = self.learn(new)
            base = len(self.young.pieces)
            at[missing[there]] = base + np.arange(there.sum())
            at[missing[~there][order]] = base + there.sum() + np.arange(len(order))
            self.young.add(lost.filter(pa.array(there)), *self.old.take(back[there]))
            self.young.add(new.take(pa.array(order)), flat, lengths)
        index = at[pieces.indices.to_numpy()]
        ids, per_piece = self.young.take(index)
        total = np.concatenate([[0], np.cumsum(per_piece, dtype=np.int64)])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])
        return ids, np.diff(total[ends])

    def decode(self, flat: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids; an id outside the vocabulary is an error."""
        import pyarrow as pa

        if not self.decodes:
            hexes = [self.bytes_of[i].hex() for i in self.token_ids.tolist()]
            self.load("vocabulary", pa.table({"t": self.token_ids, "hex": hexes}))
            self.decodes = True
        if not np.isin(flat, self.token_ids).all():
            raise ValueError("an id is not in the vocabulary")
        out = [b""] * len(n)
        self.load("token_rows", pa.table({
            "d": np.repeat(np.arange(len(n)), n), "p": np.arange(len(flat)), "t": flat,
        }))
        found = self.con.sql(_DECODE).to_arrow_table()
        for d, data in zip(found["d"].to_pylist(), found["bytes"].to_pylist()):
            out[d] = data
        return out


def parts(batch, column: str, most: int = 0) -> Iterator:
    """A record batch in slices of about ``most`` bytes of a column; a longer value stands alone."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes.astype(np.int64) + 1) // (most or BYTES)
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for first, end in zip(starts, starts[1:]):
        if end > first:
            yield batch.slice(first, end - first)
            # What the last part took is free now.
            pa.default_memory_pool().release_unused()


_TOKENIZERS: dict[tuple[str, str], Tokenizer] = {}


@contextmanager
def tokenizer(path: str, pattern: str) -> Iterator[Tokenizer]:
    """The state of one task. A worker keeps the arrays of pieces for its next task, some 25
    MB at most, but no DuckDB."""
    import pyarrow as pa

    if (path, pattern) not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[path, pattern] = Tokenizer(path, pattern)
    state = _TOKENIZERS[path, pattern]
    state.open()
    try:
        yield state
    finally:
        state.close()
        pa.default_memory_pool().release_unused()


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids",
    decoded: str | None = None,
) -> DataFrame:
    """Adds the token ids of a text, array<int>; with ``decoded``, also the bytes decoded
    from these ids.

    Null and empty texts give an empty array. Strings of special tokens are ordinary text.
    ``path`` is a rank file that every executor can open. Rows keep their columns; a column
    named like an output is replaced. There is no shuffle.
    """
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    fields = [docs.schema[c] for c in kept]
    schema = StructType(fields).add(ids, ArrayType(IntegerType(), False))
    if decoded:
        schema = schema.add(decoded, BinaryType())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with tokenizer(path, pattern) as state:
            for batch in batches:
                for part in parts(batch, text):
                    flat, n = state.encode(part.column(text))
                    ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                    columns = [*(part.column(c) for c in kept), pa.ListArray.from_arrays(ends, pa.array(flat))]
                    if decoded:
                        columns.append(pa.array(state.decode(flat, n), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, [*kept, ids, *([decoded] if decoded else [])])

    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(run, schema)


def decode(
    df: DataFrame, path: str, pattern: str, ids: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """Adds the bytes of a list of ids. Null gives null, an empty list no bytes; an id that is
    not in the vocabulary ends the job with an error."""
    kept = [c for c in df.columns if c != decoded]
    schema = StructType([df.schema[c] for c in kept]).add(decoded, BinaryType())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with tokenizer(path, pattern) as state:
            for batch in batches:
                for first in range(0, batch.num_rows, ROWS):
                    part = batch.slice(first, ROWS)
                    lists = part.column(ids)
                    n = np.array([len(x or ()) for x in lists.to_pylist()], np.int64)
                    data = state.decode(lists.drop_null().flatten().to_numpy(zero_copy_only=False), n)
                    data = [None if null else d for null, d in zip(lists.is_null().to_pylist(), data)]
                    columns = [*(part.column(c) for c in kept), pa.array(data, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, [*kept, decoded])

    return df.select(*kept).mapInArrow(run, schema)


def ids_text(ids: str) -> F.Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
