"""Token counts that follow edits.

A document's pre-tokens are kept in leaves of a segment tree whose nodes hold sums of characters and tokens. An edit finds
its leaves by character position, splits and encodes only the text of these leaves with boundary context on both sides, and
updates the sums on the way to the root; where leaves grow too large they are cut and the tree above them is laid out anew
from the sums that other leaves have already. Splitting is without memory between pre-tokens, so once a boundary falls on the
start of an old leaf beyond the edit, all that follows is as before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .encoder import BYTE_FILE, Encoder, encoder, vocabulary_path

#: Pre-tokens in a new leaf, and times that number at which a leaf has grown too large and is cut into new ones.
LEAF, GROWN = 64, 4


class TokenTree:
    def __init__(self, text: str, e: Encoder):
        if e.folds:
            raise ValueError("positions are kept only for vocabularies that leave the text as it is")
        self.e = e
        #: What splitting at one place can depend on: a special token's length, and two characters beyond white space.
        self.context = 2 + max(map(len, e.special), default=0)
        self.reencoded = 0
        words = e.words(text)
        self._layout(self._cut(words))

    def _count(self, words: list[str]) -> int:
        return sum(map(len, self.e.word_bytes(words))) // 4

    def _cut(self, words: list[str]) -> list[tuple[list[str], int, int]]:
        """(words, characters, tokens) of new leaves."""
        parts = [words[i : i + LEAF] for i in range(0, len(words), LEAF)]
        return [(part, sum(map(len, part)), self._count(part)) for part in parts]

    def _layout(self, leaves: list[tuple[list[str], int, int]]) -> None:
        """A tree over these leaves; what they hold is known already, so nothing is encoded here."""
        leaves = leaves or [([], 0, 0)]
        self.leaves = [leaf[0] for leaf in leaves]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.base, 2), np.int64)  # characters, tokens
        self.sums[self.base : self.base + len(leaves)] = [leaf[1:] for leaf in leaves]
        level = self.base
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(-1, 2, 2).sum(1)
            level //= 2

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character at position (beyond the end: the last character) and where that leaf begins."""
        position = min(position, max(0, self.n_chars - 1))
        node, start = 1, 0
        while node < self.base:
            left = int(self.sums[2 * node, 0])
            if position < start + left:
                node = 2 * node
            else:
                start, node = start + left, 2 * node + 1
        if not self.n_chars:
            return 0, 0
        return node - self.base, start

    def _set(self, leaf: int, words: list[str], tokens: int) -> None:
        self.leaves[leaf] = words
        node = self.base + leaf
        change = np.array([sum(map(len, words)), tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node >>= 1

    def edit(self, position: int, removed: int, inserted: str) -> int:
        """Takes out `removed` characters at position (both cut to the text) and puts in `inserted`; the new token count."""
        position = min(max(0, position), self.n_chars)
        removed = min(max(0, removed), self.n_chars - position)
        if not removed and not inserted:
            return self.n_tokens
        first, start = self.find(max(0, position - self.context))
        last, _ = self.find(position + removed)
        end, safe = last + 1, position + removed + self.context
        while True:
            stop, more = end, 0  # beyond the leaves to be laid anew, as many as give the context
            while stop < len(self.leaves) and more < self.context:
                more += int(self.sums[self.base + stop, 0])
                stop += 1
            old = "".join("".join(leaf) for leaf in self.leaves[first:stop])
            kept = sum(int(self.sums[self.base + i, 0]) for i in range(first, min(end, len(self.leaves))))
            new = old[: position - start] + inserted + old[position - start + removed :]
            goal = kept + len(inserted) - removed
            words = self.e.words(new)
            at, n = 0, 0
            while at < goal:
                at += len(words[n])
                n += 1
            if end >= len(self.leaves) or (at == goal and start + kept >= safe):  # kept counts characters of the text before the edit
                words = words[:n] if end < len(self.leaves) else words
                break
            end += 1
        end = min(end, len(self.leaves))
        self.reencoded += len(words)
        n_leaves = end - first
        if len(words) > GROWN * LEAF * n_leaves:
            known = [(leaf, *map(int, self.sums[self.base + i])) for i, leaf in enumerate(self.leaves)]
            self._layout(known[:first] + self._cut(words) + known[end:])
            return self.n_tokens
        per = common.ceil_div(len(words), n_leaves)
        for k in range(n_leaves):
            part = words[k * per : (k + 1) * per]
            self._set(first + k, part, self._count(part))
        return self.n_tokens


def edited_counts(docs: DataFrame, edits: Column | str = "edits", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_reencoded of every row, after its edits array<struct<pos, removed, inserted>> in order.

    pos and removed count characters and are cut to the text; a null text counts as empty, a null list as no edits, null
    fields of an edit as 0 and "". n_reencoded is how many pre-tokens the edits had encoded. Rows with the same id are
    counted each by itself; other columns aren't read; an empty table gives no rows.
    """
    path = path or vocabulary_path(BYTE_FILE)

    def count(batches):
        e = encoder(path)
        for pdf in batches:
            rows = []
            for doc_id, text, list_ in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), pdf["edits"].tolist(), strict=True):
                tree = TokenTree(text or "", e)
                before, n = tree.n_tokens, 0
                for x in list_ if list_ is not None else ():
                    if x is not None:
                        tree.edit(int(x["pos"] or 0), int(x["removed"] or 0), x["inserted"] or "")
                        n += 1
                rows.append((doc_id, before, n, tree.n_tokens, tree.reencoded))
            out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_reencoded"])
            yield out.astype({"doc_id": "Int64"})

    kind = "array<struct<pos:long,removed:long,inserted:string>>"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(edits) if isinstance(edits, str) else edits).cast(kind).alias("edits"))
    return slim.mapInPandas(count, "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_reencoded long")


def sample_edits(text: str = "text") -> Column:
    """Three edits of every text that SQL can state: a word put in at the middle, ten characters taken out at a quarter, the last character replaced."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))

    def one(pos: Column, removed: int, inserted: str) -> Column:
        return F.struct(pos.cast("long").alias("pos"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted"))

    return F.array(one(F.floor(n / 2), 0, " edited"), one(F.floor(n / 4), 10, ""), one(F.greatest(n - 4, F.lit(0)), 1, "! "))


def op7_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_counts(common.table(spark, sf_dir, "documents"), sample_edits())


QUERIES = {"op7_edit_aware_token_counts": op7_edit_aware_token_counts}
ORACLES: dict[str, str] = {}
