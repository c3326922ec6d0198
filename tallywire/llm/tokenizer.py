"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import json
import re

import numpy as np

# Fixed value: how byte-level BPE of this kind splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, by the usual rule:

    visible Latin-1 characters stand for themselves, the others follow from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return ({chr(byte): byte for byte in visible}
            | {chr(0x100 + i): byte for i, byte in enumerate(hidden)})


class ByteBPE:
    """Ids as the ``tokenizers`` library gives them for the vocabulary, several times as fast.

    Takes the file's content. Only vocabularies whose ids follow the order of their merges
    are taken, as only there ids serve as ranks; others raise ``ValueError``.
    """

    def __init__(self, content: str):
        import tiktoken

        spec = json.loads(content)
        model, letters = spec["model"], byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ()) if t.get("special")}
        ranks = {bytes(letters[c] for c in token): number
                 for token, number in model["vocab"].items() if token not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merged = [model["vocab"][a + b] for a, b in merges]
        levels = spec["pre_tokenizer"] or {}
        if (merged != sorted(merged) or spec.get("normalizer") or levels.get("type") != "ByteLevel"
                or levels.get("add_prefix_space")):
            raise ValueError("not a byte-level vocabulary with ids in the order of its merges")
        self._special = special
        self._marks = re.compile("|".join(map(re.escape, special))) if special else None
        self._encoding = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks,
                                           special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids; a special token's name in the text is that token."""
        if self._marks is None or not self._marks.search(text):
            return self._encoding.encode_to_numpy(text, disallowed_special=())
        parts, at = [], 0
        for mark in self._marks.finditer(text):
            parts.append(self._encoding.encode_to_numpy(text[at:mark.start()],
                                                        disallowed_special=()))
            parts.append(np.array([self._special[mark.group()]], np.uint32))
            at = mark.end()
        parts.append(self._encoding.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(parts)
