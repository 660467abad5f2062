"""Edit-aware token counts: a segment tree over pre-tokens per document; an edit re-encodes only what it touches."""

from __future__ import annotations

import base64
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sqlyard.llm.common import id_and_text, text_slices


class Counter:
    """Tokens per pre-token by the tiktoken library; a vocabulary file of ranks and a pre-token pattern."""

    def __init__(self, path: str, pattern: str, most: int = 1 << 18):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.library = tiktoken.Encoding("edits", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.most, self.known = regex.compile(pattern), most, {}
        self.encoded = 0  # characters of pre-tokens counted so far

    def count(self, part: str) -> int:
        self.encoded += len(part)
        found = self.known.get(part)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[part] = len(self.library.encode_ordinary(part))
        return found

    def parts(self, text: str, start: int = 0):
        return (m.group() for m in self.pattern.finditer(text, start))


class CountTree:
    """Token count of one text under edits.

    Leaves are runs of pre-tokens, and a binary tree of sums over them, characters and tokens, lies in two arrays: node i has
    the children 2i and 2i + 1. Finding a place and updating the sums of a leaf take one way through the tree. A leaf that
    has grown to twice its size makes the tree be laid out anew, from the counts it has: nothing is encoded again.
    """

    def __init__(self, text: str, counter: Counter, leaf: int = 64):
        self.counter, self.leaf = counter, leaf
        self._layout([(p, counter.count(p)) for p in counter.parts(text)])

    def _layout(self, parts: list[tuple[str, int]]) -> None:
        self.leaves = [parts[i: i + self.leaf] for i in range(0, len(parts), self.leaf)] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, held in enumerate(self.leaves):
            self.chars[self.width + i] = sum(len(p) for p, _ in held)
            self.tokens[self.width + i] = sum(n for _, n in held)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, k: int) -> None:
        i = self.width + k
        self.chars[i], self.tokens[i] = sum(len(p) for p, _ in self.leaves[k]), sum(n for _, n in self.leaves[k])
        while i > 1:
            i //= 2
            self._sum(i)

    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for held in self.leaves for p, _ in held)

    def _find(self, at: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the pre-token that holds character ``at`` or ends there."""
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if at > before + self.chars[i]:
                before += self.chars[i]
                i += 1
        k = min(i - self.width, len(self.leaves) - 1)
        for j, (part, _) in enumerate(self.leaves[k]):
            if at <= before + len(part):
                return k, j, before
            before += len(part)
        return k, len(self.leaves[k]), before

    def _walk(self, k: int, j: int):
        while k < len(self.leaves):
            held = self.leaves[k]
            while j < len(held):
                yield k, j, held[j]
                j += 1
            k, j = k + 1, 0

    def edit(self, at: int, removed: int, inserted: str) -> None:
        """Replaces ``removed`` characters from ``at`` on.

        A pre-token depends on its own characters and one behind it, so the first one that can change is the one that
        holds the character before the edit. From there the new text is cut again, until a cut behind the
        edit meets an old one: all that follows is as it was.
        """
        at = max(0, min(at, self.chars[1]))
        removed = max(0, min(removed, self.chars[1] - at))
        k, j, begin = self._find(max(0, at - 1))
        walk, old, taken, last = self._walk(k, j), [], 0, (k, j)
        ends = {0}  # cuts of the old text, counted from ``begin``

        def more(until: int) -> None:
            nonlocal taken, last
            for kk, jj, (part, _) in walk:
                old.append(part)
                taken += len(part)
                ends.add(taken)
                last = (kk, jj + 1)
                if taken >= until:
                    return

        more(at + removed - begin + 1)
        reach, shift = 1, len(inserted) - removed
        while True:
            before = "".join(old)
            now = before[: at - begin] + inserted + before[at - begin + removed:]
            fresh, size, met = [], 0, None
            for part in self.counter.parts(now):
                if size >= at - begin + len(inserted) and size - shift in ends and size < len(now):
                    met = size - shift
                    break
                fresh.append(part)
                size += len(part)
            # the last pieces of what was read may look different with the text that follows: a cut counts if a whole part stands behind it
            if met is not None and taken > met:
                break
            had = taken
            reach *= 2
            more(taken + 64 * reach)
            if taken == had:
                met = taken
                break
        stop, seen = (k, j), 0
        for kk, jj, (part, _) in self._walk(k, j):
            if seen >= met:
                break
            seen += len(part)
            stop = (kk, jj + 1)
        self._replace((k, j), stop, [(p, self.counter.count(p)) for p in fresh])

    def _replace(self, first: tuple[int, int], stop: tuple[int, int], parts: list[tuple[str, int]]) -> None:
        (k, j), (last, end) = first, stop
        if last == k:
            self.leaves[k][j:end] = parts
        else:
            self.leaves[k][j:] = parts
            del self.leaves[last][:end]
            for middle in range(k + 1, last):
                self.leaves[middle] = []
        if len(self.leaves[k]) > 2 * self.leaf:
            self._layout([x for held in self.leaves for x in held])
            return
        for changed in range(k, last + 1):
            self._set(changed)


#: The edits of the count query, as shares of a text's length: place, characters removed, text put in.
EDITS = ((0.25, 9, "don't stop"), (0.5, 0, " and so on,"), (0.75, 30, ""), (0.5, 1, "  \n "))


def count_edits(
    docs: DataFrame, vocabulary: str, pattern: str, edits: Sequence[tuple[float, int, str]] = EDITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, edited_tokens, n_chars, edited_chars, recounted_chars)`` per row.

    Each text is counted, then changed by ``edits`` in turn, each at a share of the length the text then has. Counts after
    the edits come from the tree; ``recounted_chars`` says how many characters the edits made it encode. Null text is empty; repeated rows are counted each, an
    empty table gives no rows, and a very long text has one tree in one task.
    """
    def run(batches):
        counter = Counter(vocabulary, pattern)
        for batch in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tree = CountTree(text or "", counter)
                n, counter.encoded = tree.total(), 0
                for share, removed, inserted in edits:
                    tree.edit(int(tree.chars[1] * share), removed, inserted)
                rows.append((doc_id, n, tree.total(), len(text or ""), tree.chars[1], counter.encoded))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    names = ["doc_id", "n_tokens", "edited_tokens", "n_chars", "edited_chars", "recounted_chars"]
    return id_and_text(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{n} long" for n in names))
