"""Token counts by a whole-token shortcut over a byte-level BPE vocabulary.

Once per vocabulary, on the driver: every vocabulary string is run through the
merges; those that come out as the one token they name are *proven* whole
tokens.  In the tasks a text is cut into pre-tokens; a pre-token that is a
proven string counts 1 straight from a dictionary, and only the others are
merged (each distinct one once per worker, in O(n log n) for any length).

Results: one row per input row.  Null text counts as empty (0 bytes, 0
tokens).  Whole texts of any length are counted.  Repeated rows give repeated
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, map_rows

#: Fixed value: how this family of vocabularies cuts a text before merging.
#: White space is spelled out, because Python's ``\s`` also takes 0x1C-0x1F.
_WS = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"

#: Distinct merged pre-tokens a worker remembers before it starts anew.
MEMORY = 1_000_000
NO_MERGE = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others are numbered
    from 256 on in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(b): b for b in own}
    for i, b in enumerate(sorted(set(range(256)) - set(own))):
        chars[chr(256 + i)] = b
    return chars


class Vocabulary:
    """Merges and proven whole tokens of a ``tokenizers`` BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, ids = byte_alphabet(), spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.byte_id = [0] * 256
        for char, b in alphabet.items():
            self.byte_id[b] = ids[char]
        # a pair's merge as one number, rank first, so that the least is next
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = rank << 20 | ids[a + b]
        self.whole = set()
        for token, i in ids.items():
            if all(c in alphabet for c in token):
                raw = bytes(alphabet[c] for c in token)
                if self.encode(raw) == [i]:
                    try:
                        self.whole.add(raw.decode("utf-8"))
                    except UnicodeDecodeError:
                        pass  # part of a character: never a pre-token

    def encode(self, raw: bytes) -> list[int]:
        """Merge by rank, leftmost first among equal ranks."""
        ids = [self.byte_id[b] for b in raw]
        return self._merge_short(ids) if len(ids) <= 64 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        pairs = [get(p, NO_MERGE) for p in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != NO_MERGE:
            i = pairs.index(best)
            ids[i] = best & 0xFFFFF
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), NO_MERGE)
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for any length."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j], after[i] = m & 0xFFFFF, -1, after[j]
            if (k := after[j]) < n:
                before[k] = i
                if (m := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (m, i, ids[i], ids[k]))
            if (p := before[i]) >= 0 and (m := get((ids[p], ids[i]))) is not None:
                heapq.heappush(heap, (m, p, ids[p], ids[i]))
        return [x for x in ids if x >= 0]


class _Counts(dict):
    """Tokens of a pre-token; merged on first sight."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(dict.fromkeys(vocabulary.whole, 1))
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        n = len(self.vocabulary.encode(piece.encode("utf-8")))
        if len(self) > MEMORY:
            self.clear()
            self.update(dict.fromkeys(self.vocabulary.whole, 1))
        self[piece] = n
        return n


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        import regex
        self.counts = _Counts(vocabulary)
        self.specials = vocabulary.specials
        self.cut = regex.compile("|".join(regex.escape(s) for s in self.specials)) if self.specials else None
        self.pieces = regex.compile(PRE_TOKEN).findall

    def __call__(self, text: str) -> int:
        if self.cut is None or not any(s in text for s in self.specials):
            return sum(map(self.counts.__getitem__, self.pieces(text)))
        parts = self.cut.split(text)  # a special string inside a text is one token
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.pieces(p))) for p in parts)


#: The counter of the worker's vocabulary, with what it has merged so far.
_LOADED: dict = {}


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every text, as the tokenizer
    library counts them without added tokens.  The vocabulary (fixed size,
    about 2 MB) is read on the driver and broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def count(rows: pa.RecordBatch):
        vocabulary = shared.value  # one object per worker
        if _LOADED.get("of") is not vocabulary:
            _LOADED.update(of=vocabulary, counter=Counter(vocabulary))
        counter = _LOADED["counter"]
        text = rows["t"]
        yield batch(i=rows["i"], b=pc.cast(pc.fill_null(pc.binary_length(text), 0), pa.int64()),
                    n=pa.array([counter(t.as_py()) if t.is_valid else 0 for t in text], pa.int64()))

    id_type = docs.schema[id_col].dataType.simpleString()
    out = map_rows(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), count, f"i {id_type}, b bigint, n bigint")
    return out.select(F.col("i").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
