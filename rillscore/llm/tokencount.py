"""Token counts by byte-pair merging with a heap of adjacent pairs over a linked list of symbols.

The count is the number of initial symbols minus the number of merges; no identifiers are made. Vocabulary semantics are
those of a sentencepiece BPE model with identity normalisation, a dummy prefix and byte fallback.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import per_text

SPACE = "▁"  # what a blank becomes


class Merges:
    """piece -> rank (0 merges first) of all pieces that merging can make; sent to executors whole (tens of thousands)."""

    def __init__(self, pieces: dict[str, float], prefix: bool = True):
        order = sorted(pieces, key=lambda p: -pieces[p])
        self.rank = {p: i for i, p in enumerate(order)}
        self.prefix = prefix
        # No merge crosses two characters that stand side by side in no piece: a text can be cut there and each part
        # counted alone, and kept. Blanks are such places for all vocabularies whose pieces hold blanks in front only.
        self.inner = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.stretches = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) else ".+", re.S)
        self.kept: dict[str, int] = {}  # in two generations, so that frequent stretches stay
        self.older: dict[str, int] = {}

    @classmethod
    def of_sentencepiece(cls, path: str) -> Merges:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(sp.encode(t, out_type=str) != [SPACE, *want] for t, want in (("\0", ["<0x00>"]), ("ａ１", ["<0xEF>", "<0xBD>", "<0x81>", "<0xEF>", "<0xBC>", "<0x91>"]))):
            raise ValueError("only models with identity normalisation, a dummy prefix and byte fallback are supported")
        return cls({sp.id_to_piece(i): sp.get_score(i) for i in ids})

    def stretch(self, s: str) -> int:
        """Tokens of one stretch: pop the lowest-ranked adjacent pair (leftmost of equals) until none is left."""
        rank, n = self.rank, len(s)
        pair = list(map(str.__add__, s, s[1:]))
        # A heap entry is rank * n + place. A place holds its current pair's entry; others on the heap are stale.
        entry = [rank[p] * n + i if p in rank else -1 for i, p in enumerate(pair)]
        heap = [e for e in entry if e >= 0]
        entry.append(-1)
        merges = 0
        if heap:
            heapq.heapify(heap)
            pop, push = heapq.heappop, heapq.heappush
            sym: list[str] = list(s)
            left, right = list(range(-1, n - 1)), [*range(1, n), -1]
            while heap:
                e = pop(heap)
                i = e % n
                if entry[i] != e:
                    continue  # one of the two has merged meanwhile
                j = right[i]
                sym[i] = p = sym[i] + sym[j]
                merges += 1
                entry[j] = entry[i] = -1
                right[i] = k = right[j]
                if k >= 0:
                    left[k] = i
                    if (r := rank.get(p + sym[k])) is not None:
                        entry[i] = r * n + i
                        push(heap, entry[i])
                if (h := left[i]) >= 0:
                    entry[h] = -1
                    if (r := rank.get(sym[h] + p)) is not None:
                        entry[h] = r * n + h
                        push(heap, entry[h])
        # A character that is no piece falls back to its bytes.
        return sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in s) - merges

    def parts(self, s: str) -> int:
        """Tokens of a stretch, cut where no piece reaches across."""
        inner, a, total = self.inner, 0, 0
        for z in [i for i in range(1, len(s)) if s[i - 1 : i + 1] not in inner] + [len(s)]:
            total += self.known(s[a:z], self.stretch)
            a = z
        return total

    def known(self, s: str, count: Callable[[str], int]) -> int:
        """From what is kept, or else counted and kept (at most 800,000 stretches of up to 32 characters)."""
        n = self.kept.get(s)
        if n is None:
            n = self.older.get(s)
            if n is None:
                n = count(s)
            if len(s) <= 32:
                if len(self.kept) >= 400_000:
                    self.older, self.kept = self.kept, {}
                self.kept[s] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, parts = 0, self.parts
        for s in self.stretches.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE)):
            n = self.kept.get(s)
            total += self.known(s, parts) if n is None else n
        return total


def count_tokens(df: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts count 0 bytes and 0 tokens. Repeated rows are counted each. Whole texts are counted, however
    long: a stretch without blanks costs n log n. Narrow: no shuffle, one pass, memory bounded by the longest text.
    """
    merges = Merges.of_sentencepiece(model_path)

    def counts(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64()), pa.array([merges.count(t) for t in texts], pa.int64())]

    return per_text(df, text_col, [id_col], "n_bytes long, n_tokens long", counts).withColumn("over_limit", F.col("n_tokens") > limit)
