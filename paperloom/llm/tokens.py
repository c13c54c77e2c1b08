"""Token ids of whole texts with a public tokenizer file, inside tasks."""

import os
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Texts encoded at a time, and words whose ids a task remembers at most.
TEXTS, REMEMBERED = 500, 800_000


def tokenizer_path() -> str:
    """The public vocabulary that the registered queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def largest_id(path: str) -> int:
    """The largest token id of a vocabulary file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


# A word of lower-case Latin letters, which no normalizer changes and no rule of the vocabulary splits,
# with signs and digits behind it, which are split from it.
PLAIN = rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-@\[-`{-~]*)"


class WordEncoder:
    """Token ids of texts, for tokenizers that never join characters across white space, nor letters
    and other signs, and that work on lower case.

    Such a tokenizer gives for a text the ids of its blank-separated words, one after another,
    so each distinct word is encoded once and remembered. The memory is bounded: it starts
    anew when full.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # For plain words the other steps change nothing.
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for tokenizer in (self.whole, self.letters):
            tokenizer.model._resize_cache(0)  # every word comes once
        self.plain = re.compile(PLAIN).fullmatch
        self.known: dict[bytes, bytes] = {}

    def learn(self, fresh: set[bytes]) -> None:
        plain, other, joined = set(), set(), []
        for word in fresh:
            parts = self.plain(word)
            if parts is None:
                other.add(word)
            elif not parts[2]:
                plain.add(word)
            else:
                joined.append((word, parts[1], parts[2]))
        for _, letters, signs in joined:
            plain.add(letters)
            other.add(signs)
        self.remember(self.letters, plain.difference(self.known))
        self.remember(self.whole, other.difference(self.known))
        for word, letters, signs in joined:
            self.known[word] = self.known[letters] + self.known[signs]

    def remember(self, tokenizer, words: set[bytes]) -> None:
        rest = list(words)
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            found = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for word, encoding in zip(part, found):
                self.known[word] = array("I", encoding.ids).tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; none for null."""
        for at in range(0, len(texts), TEXTS):
            split = [self.split(t) for t in texts[at:at + TEXTS]]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.learn(set().union(*split).difference(self.known))
            ids = self.known.__getitem__
            for words in split:
                yield b"".join(map(ids, words))

    @staticmethod
    def split(text: str | None) -> list[bytes]:
        if not text:
            return []
        # Like most runs of the vocabulary's normalizer, lower-casing keeps the memory small. Where a
        # text may hold special tokens, case tells them apart, so such a text is left as it is.
        raw = text.encode()
        return (raw if b"<|" in raw else raw.lower()).split()


def kept_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which next tasks on it take over with the words it remembers.

    This module travels with each task, so the encoder is kept in the table of modules, which does not.
    """
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    if path not in vars(kept):
        setattr(kept, path, WordEncoder(path))
    return vars(kept)[path]


def encoded(
    batches: Iterable[pa.RecordBatch], path: str, end_id: int, encoder: WordEncoder | None = None
) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids with the end id) of each row (doc_id, text), by `encoder` or a new one."""
    encoder, end = encoder or WordEncoder(path), np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            ids = encoder.encode(part.column(1).to_pylist())
            for doc_id, found in zip(part.column(0).to_pylist(), ids):
                yield doc_id, found + end
