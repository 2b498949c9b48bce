"""Token ids of a public byte-level BPE, encoded stretch by stretch with a bounded memory of stretches."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from kitchenlight.llm.common import only

MEMORY_STRETCHES = 500_000
LONG_STRETCH = 48
JOINED = 256
CHUNK_CHARS = 1 << 20

_ODD_SPACE = re.compile(r" (?=\s|$)")
_SPACE_BEFORE_WORD = re.compile(r" (?=\S)")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to the library's for the whole text.

    The vocabulary's splitting rule always starts a new piece at a space that a non-space follows, so a text may be cut
    there and equal stretches, once encoded by the library, need not be encoded again.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import numpy as np
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.opens = np.array([self.library.id_to_token(i).startswith("\u0120") for i in range(self.library.get_vocab_size())])
        self.known: dict[str, bytes] = {}

    def _learn(self, stretches: list[str]) -> None:
        """Encode many stretches as one text: each begins with the only token of it that starts with a space.

        The few that hold further spaces are encoded one by one.
        """
        import numpy as np

        spaced = [s for s in stretches if " " in s]
        for stretch, found in zip(spaced, self.library.encode_batch_fast([" " + s for s in spaced], add_special_tokens=False)):
            self.known[stretch] = np.array(found.ids, "<u4").tobytes()
        stretches = [s for s in stretches if " " not in s]
        groups = [" " + " ".join(stretches[i : i + JOINED]) for i in range(0, len(stretches), JOINED)]
        parts = [np.array(found.ids, "<u4") for found in self.library.encode_batch_fast(groups, add_special_tokens=False)]
        if not parts:
            return
        ids = np.concatenate(parts)
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(stretches):
            raise ValueError("the vocabulary does not start a piece at a space before a word")
        whole, marks = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
        self.known.update((stretch, whole[i:j]) for stretch, i, j in zip(stretches, marks, marks[1:]))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        held: list[str] = []
        size = 0
        for i, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= CHUNK_CHARS or i == len(texts) - 1:
                yield from self._encode(held)
                held, size = [], 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        cut = [_SPACE_BEFORE_WORD.split(t) if _ODD_SPACE.search(t) else t.split(" ") for t in texts]
        first = self.library.encode_batch_fast([stretches.pop(0) for stretches in cut], add_special_tokens=False)
        new = set().union(*cut).difference(self.known)
        self._learn(list(new))
        get = self.known.__getitem__
        out = [np.array(f.ids, "<u4").tobytes() + b"".join(map(get, stretches)) for f, stretches in zip(first, cut)]
        if len(self.known) > MEMORY_STRETCHES:
            self.known.clear()
        else:
            for stretch in new:
                if len(stretch) > LONG_STRETCH:
                    del self.known[stretch]
        return out


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, as long as the worker encodes."""
    return only(f"encoder {path}", lambda: Encoder(path))
