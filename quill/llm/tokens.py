"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary comes in two forms: ranks for tiktoken, several times faster,
and a file for tokenizers, which defines the ids. Texts whose characters both
libraries certainly split alike (Latin letters and common punctuation, no
special token spelled out) go to tiktoken, all others to tokenizers.
"""

from __future__ import annotations

import base64
import re

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
#: Latin, Latin extended, general punctuation marks, the euro sign
PLAIN = re.compile("[\x00-ɏ‐-‧‰-⁞€]*")


class Encoder:
    """Made inside a task; the files are found there by the vocabulary's name."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers as files
        import tiktoken

        with open(files.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=files.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.path = files.path(f"{vocabulary}.json")
        self.full = None

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if SPECIAL not in text:
            try:
                text.encode("latin-1")
                return self.fast.encode_ordinary(text)
            except UnicodeEncodeError:
                if PLAIN.fullmatch(text):
                    return self.fast.encode_ordinary(text)
        if self.full is None:
            from tokenizers import Tokenizer
            self.full = Tokenizer.from_file(self.path)
        return self.full.encode(text, add_special_tokens=False).ids
