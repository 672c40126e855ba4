"""Token counts by merging many pre-tokens at once.

A pre-token is a run of blanks with the letters after it; no piece of the
vocabulary reaches from a letter into a blank behind it, so pre-tokens can be
counted apart. All new pre-tokens of a batch lie one after the other in flat
arrays. In every round each of them finds its pair of lowest rank and joins it;
sequences without a pair leave the arrays. What is left is counted.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewarden.llm.common import by_slices, doc_texts, vocabulary_path

PIECE_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
BLANK = "▁"
NO_RANK = np.int32(2**31 - 1)
#: From so many characters on a pre-token is merged over linked symbols.
LONG_WORD = 2000

#: Counts of pre-tokens kept between batches; only the memory of a worker depends on it.
CACHE_ENTRIES = 1_000_000


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not self._outside(model, i)]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in ids}
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("pieces with a blank behind a letter can't be cut before blanks")
        # white space that stands in no piece is always a cut
        lone = "".join(c for c in "\n\t\r" if not any(c in p for p in pieces if len(p) > 1))
        cut = re.escape(lone)
        self.pattern = re.compile(f"{BLANK}+[^{BLANK}{cut}]*|[^{BLANK}{cut}]+" + (f"|[{cut}]" if lone else ""))

        letters = {c for p in pieces for c in p}
        self.numbers = {s: k for k, s in enumerate(sorted(letters | set(pieces)))}
        self.letters = {c: self.numbers[c] for c in letters}
        # a letter without a piece of its own is written as its bytes
        self.cost = np.ones(len(self.numbers) + 1, np.int64)
        for c in letters - set(pieces):
            self.cost[self.numbers[c]] = len(c.encode("utf-8"))
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        holders = np.bincount([order[s] for s in pieces.values()], minlength=len(order))
        pairs = {}
        early = set()
        for piece, score in pieces.items():
            for at in range(1, len(piece)):
                left, right = piece[:at], piece[at:]
                if left in self.numbers and right in self.numbers:
                    pairs[self.numbers[left] << 32 | self.numbers[right]] = (order[score], self.numbers[piece])
                    early.update(order[pieces[x]] for x in (left, right) if x in pieces and pieces[x] <= score)
        self.keys = np.array(sorted(pairs), np.int64)
        found = [pairs[k] for k in self.keys.tolist()]
        self.ranks = np.array([r for r, _ in found], np.int32)
        self.merged = np.array([m for _, m in found], np.int32)
        # ranks whose pairs may all be joined in one round: one piece has the rank,
        # and nothing that it makes possible comes before it
        self.together = holders == 1
        self.together[list(early)] = False
        self.counts: dict[str, int] = {}
        self.long_words: set[str] = set()

    @staticmethod
    def _outside(model, i: int) -> bool:
        return model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair of neighbours."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]

    def merge(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        if not long:
            return self._merge_together(words)
        total = np.zeros(len(words), np.int64)
        total[long] = [self._merge_long(words[k]) for k in long]
        rest = np.setdiff1d(np.arange(len(words)), long)
        total[rest] = self._merge_together([words[k] for k in rest.tolist()])
        return total

    def _merge_long(self, word: str) -> int:
        """Tokens of one very long pre-token.

        The same rounds, lowest rank first, over linked symbols: places wait
        under the rank of their pair, and a round touches only its own.
        """
        get, other = self.letters.get, len(self.numbers)
        symbols = np.fromiter((get(c, other) for c in word), np.int32, len(word))
        extra = sum(len(word[i].encode("utf-8")) - 1 for i in np.flatnonzero(symbols == other).tolist())
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[(at >= 0) & (after[at] < n)]
            ranks = self._pairs(symbols[at], symbols[after[at]])[0]
            at, ranks = at[ranks != NO_RANK], ranks[ranks != NO_RANK]
            by = np.argsort(ranks, kind="stable")
            cuts = np.flatnonzero(np.diff(ranks[by])) + 1
            for some in np.split(at[by], cuts) if len(at) else ():
                rank = int(self._pairs(symbols[some[:1]], symbols[after[some[:1]]])[0][0])
                if rank not in waiting:
                    heapq.heappush(order, rank)
                waiting.setdefault(rank, []).append(some)

        wait(np.arange(n))
        while order:
            rank = heapq.heappop(order)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[alive[at] & (after[at] < n)]
            ranks, made = self._pairs(symbols[at], symbols[after[at]])
            at, made = at[ranks == rank], made[ranks == rank]
            if not len(at):
                continue
            # of neighbours in a run every second one, from the left
            new_run = np.r_[True, after[at[:-1]] != at[1:]]
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            chosen = (np.arange(len(at)) - run_start) % 2 == 0
            if not self.together[rank]:
                chosen[1:] = False
                if len(at) > 1:
                    heapq.heappush(order, rank)
                    waiting[rank] = [at[1:]]
            place = at[chosen]
            gone = after[place]
            symbols[place] = made[chosen]
            alive[gone] = False
            after[place] = follows = after[gone]
            inside = follows < n
            before[follows[inside]] = place[inside]
            wait(np.unique(np.concatenate([place, before[place]])))
        return int(self.cost[symbols[alive]].sum()) + extra

    def _merge_together(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, all of them side by side."""
        get, other = self.letters.get, len(self.numbers)
        sizes = np.array([len(w) for w in words], np.int64)
        flat = "".join(words)
        symbols = np.fromiter((get(c, other) for c in flat), np.int32, len(flat))
        total = np.zeros(len(words), np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        # letters that stand in no piece: one token for each byte
        unknown = np.flatnonzero(symbols == other)
        if len(unknown):
            extra = np.array([len(flat[i].encode("utf-8")) - 1 for i in unknown.tolist()], np.int64)
            np.add.at(total, owner[unknown], extra)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        made = np.zeros(len(symbols), np.int32)
        self._refresh(symbols, owner, rank, made, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(symbols)])
            least = np.minimum.reduceat(rank, starts)
            done = least == NO_RANK
            if done.any():
                ended = np.repeat(done, lengths)
                np.add.at(total, owner[ended], self.cost[symbols[ended]])
                keep = ~ended
                symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else starts[:0]
                lengths, least = lengths[~done], least[~done]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            # of neighbours in a run every second one, from the left
            new_run = np.r_[True, (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])]
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            chosen = (np.arange(len(at)) - run_start) % 2 == 0
            first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
            at = at[chosen & (first | self.together[rank[at]])]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            at = place[at]
            before = at[at > 0] - 1
            self._refresh(symbols, owner, rank, made, np.unique(np.r_[before, at]))
        return total

    def _refresh(self, symbols, owner, rank, made, at) -> None:
        """Ranks of the pairs that start at the given places."""
        rank[at] = NO_RANK
        inner = at[at < len(symbols) - 1]
        inner = inner[owner[inner] == owner[inner + 1]]
        rank[inner], made[inner] = self._pairs(symbols[inner], symbols[inner + 1])

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, without begin and end."""
        if len(self.counts) > CACHE_ENTRIES:
            self.counts.clear()
        counts = self.counts
        # words are kept whatever their text was, very long ones are not
        for word in [w for w in self.long_words if w in counts]:
            del counts[word]
        self.long_words.clear()
        split = [self.pattern.findall((BLANK + t).replace(" ", BLANK)) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in counts})
        self.long_words.update(w for w in new if len(w) > LONG_WORD)
        if new:
            counts.update(zip(new, self.merge(new).tolist(), strict=True))
        return [sum(map(counts.__getitem__, words)) for words in split]


@lru_cache(maxsize=4)
def piece_counter(name: str) -> PieceCounter:
    return PieceCounter(vocabulary_path(name))


def count_tokens(docs: DataFrame, vocabulary: str = PIECE_VOCABULARY, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    A null or empty text has no token. Repeated rows stay repeated, other
    columns are left out.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        tokens = np.array(piece_counter(vocabulary).count(texts), np.int64)
        size = np.array([len(t.encode("utf-8")) for t in texts], np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return doc_texts(docs).mapInArrow(by_slices(count), schema)
