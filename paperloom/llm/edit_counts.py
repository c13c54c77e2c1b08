"""Token counts that follow edits: a tree of segment sums per document, re-encoded where edits touch it.

Trees are rows (doc_id, parts, tokens): the segments of a text and the token count of each. `build_trees` makes
them once; written as a table they take batch after batch of edits, each of which encodes what it touches alone.
"""

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.tokens import WordEncoder

# Characters of a segment, at least; it ends behind the next blank.
SEGMENT = 256


def segments(text: str) -> list[str]:
    """Cut behind blanks, where no token reaches across."""
    blank, found, start = re.compile("[ \t\n\x0b\x0c\r]"), [], 0
    while (cut := blank.search(text, start + SEGMENT)) is not None:
        found.append(text[start:cut.end()])
        start = cut.end()
    return [*found, text[start:]]


class SegmentTree:
    """Sums of characters and tokens over the segments of a document; leaf i is node `width` + i."""

    def __init__(self, parts: list[str], tokens: list[int]):
        self.parts, self.touched = parts, set()
        self.width = 1 << (len(parts) - 1).bit_length()
        fill = [0] * (self.width - len(parts))
        self.chars = [0] * self.width + [len(p) for p in parts] + fill
        self.tokens = [0] * self.width + tokens + fill
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """Segment that holds character `at`, and the place in it; the end of the text is in the last one
        that is not empty, as text put there continues its last word."""
        node = 1
        if at >= self.chars[1]:
            while node < self.width:
                node = 2 * node + (self.chars[2 * node + 1] > 0)
            return node - self.width, self.chars[node]
        while node < self.width:
            node *= 2
            if at >= self.chars[node]:
                at -= self.chars[node]
                node += 1
        return node - self.width, at

    def put(self, at: int, part: str, tokens: int) -> None:
        """Set a segment and update the sums above it."""
        self.parts[at] = part
        node = self.width + at
        self.chars[node], self.tokens[node] = len(part), tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, new: str, encoder: WordEncoder) -> int:
        """Replace characters start to end by `new`; the number of characters that were encoded anew.

        The region is the segments that the edit touches; if it then no longer ends in a blank, the
        next segments belong to its last word and join it. The one before it ends in a blank.
        """
        start = max(0, min(start, self.chars[1]))
        end = max(start, min(end, self.chars[1]))
        (first, before), (last, behind) = self.find(start), self.find(end)
        region = self.parts[first][:before] + new + self.parts[last][behind:]
        while region and not region[-1].isspace() and last + 1 < len(self.parts):
            last += 1
            region += self.parts[last]
        self.put(first, region, len(next(encoder.encode([region]))) // 4)
        for at in range(first + 1, last + 1):
            self.put(at, "", 0)
        self.touched.add(first)
        return len(region)

    def leaves(self, encoder: WordEncoder) -> tuple[list[str], list[int]]:
        """Segments and their tokens, without emptied ones; those that edits made long are cut again."""
        parts, tokens = [], []
        for at, part in enumerate(self.parts):
            cut = segments(part) if at in self.touched and len(part) > 4 * SEGMENT else [part]
            cut = [p for p in cut if p]
            parts += cut
            tokens += [self.tokens[self.width + at]] if len(cut) == 1 else [len(i) // 4 for i in encoder.encode(cut)]
        return (parts, tokens) if parts else ([""], [0])


# Rows that a task turns at a time.
ROWS = 200
EDITS = "array<struct<start:bigint,end:bigint,new:string>>"
COUNTS = ("n_tokens", "n_edits", "edited_tokens", "edited_chars", "encoded_chars")


def build_trees(docs: DataFrame, tokenizer: str, carried: str | None = None) -> DataFrame:
    """(doc_id, parts array<string>, tokens array<int>) per row of `docs` (doc_id, text), with the column `carried`.

    The only step that encodes whole texts. A null or empty text is one empty segment; repeated rows and null
    ids are rows like others; other columns are ignored. For tokenizers that never join characters across blanks.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cut = [segments(t or "") for t in part.column(1).to_pylist()]
                counts = iter([len(ids) // 4 for ids in encoder.encode([s for parts in cut for s in parts])])
                tokens = [[next(counts) for _ in parts] for parts in cut]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cut, pa.list_(pa.string())), pa.array(tokens, pa.list_(pa.int32())),
                     *part.columns[2:]], names=["doc_id", "parts", "tokens", *part.schema.names[2:]])

    more = [carried] if carried else []
    ready = docs.select(F.col("doc_id").cast("long"), "text", *more)
    kinds = "".join(f", {c} {ready.schema[c].dataType.simpleString()}" for c in more)
    return ready.mapInArrow(run, f"doc_id long, parts array<string>, tokens array<int>{kinds}")


def apply_edits(trees: DataFrame, tokenizer: str, with_trees: bool = True) -> DataFrame:
    """(doc_id, n_tokens, n_edits, edited_tokens, edited_chars, encoded_chars, parts, tokens) per row of
    `trees` (doc_id, parts, tokens, edits array<struct<start, end, new>>), without the last two if not asked for.

    `n_tokens` is the count before the edits, `edited_tokens` behind them, as if the edited text were encoded
    anew; `encoded_chars` says how much was. Edits apply in order; each counts characters, from 0, in the
    text that the ones before it left, and is clipped to it; a null `new` is a deletion, a null place 0, null edits
    are none. Repeated rows and null ids are rows like others. A task holds the tree of one document.
    """
    kinds = [pa.int64()] * 6 + ([pa.list_(pa.string()), pa.list_(pa.int32())] if with_trees else [])
    names = ["doc_id", *COUNTS, *(["parts", "tokens"] if with_trees else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = []
                for doc_id, parts, tokens, edits in zip(*[c.to_pylist() for c in batch.slice(at, ROWS).columns]):
                    tree = SegmentTree(parts, tokens)
                    before, encoded = tree.tokens[1], 0
                    edits = [e for e in edits or [] if e is not None]
                    for edit in edits:
                        encoded += tree.edit(edit["start"] or 0, edit["end"] or 0, edit["new"] or "", encoder)
                    kept = tree.leaves(encoder) if with_trees else ()
                    rows.append((doc_id, before, len(edits), tree.tokens[1], tree.chars[1], encoded, *kept))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    ready = trees.select("doc_id", "parts", "tokens", F.col("edits").cast(EDITS))
    schema = ", ".join(f"{n} long" for n in ("doc_id", *COUNTS))
    return ready.mapInArrow(run, schema + (", parts array<string>, tokens array<int>" if with_trees else ""))


def edit_trees(trees: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of `trees` that `edits` (doc_id, seq, start, end, new) touch, as `apply_edits` gives them.

    A document's edits apply in the order of `seq`, equal ones by place and text, so they meet in one task. Repeated
    rows of a document take all of them; edits without id or document change nothing. No edits give no rows.
    """
    edit = F.struct("seq", "start", "end", "new")
    lists = edits.where("doc_id is not null").select(F.col("doc_id").cast("long"), edit.alias("e")).groupBy("doc_id").agg(
        F.array_sort(F.collect_list("e")).alias("e"))
    taken = lists.select("doc_id", F.transform("e", lambda e: F.struct(e["start"], e["end"], e["new"])).cast(EDITS).alias("edits"))
    return apply_edits(trees.join(taken, "doc_id"), tokenizer)


def put_trees(trees: DataFrame, changed: DataFrame) -> DataFrame:
    """All trees after `changed`, a written result of `edit_trees`, has replaced those of the same ids."""
    kept = trees.select("doc_id", "parts", "tokens").join(changed.select("doc_id"), "doc_id", "left_anti")
    return kept.unionByName(changed.select("doc_id", "parts", "tokens"))


def count_edited(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, n_edits, edited_tokens, edited_chars, encoded_chars) per row of `docs` (doc_id, text,
    edits), for a single batch of edits: trees are built, edited and not kept. Rows as for the two steps."""
    return apply_edits(build_trees(docs, tokenizer, "edits"), tokenizer, with_trees=False)
