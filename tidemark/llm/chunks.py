"""Encoding of whole texts through a bounded store of pieces already encoded.

A space followed by a character that is not white space always starts a new match of the pre-token pattern, and
what lies between two such places is matched as if it stood alone. So a text may be cut there, and every distinct
piece is encoded once while it is in the store. A text that holds a space before other white space, or at an end,
is encoded as one piece.
"""


class PieceStore:
    """`encode_many` maps a list of strings to a list of bytes (ids as little-endian unsigned 32-bit integers)."""

    def __init__(self, encode_many, limit=600_000):
        self.encode_many, self.limit = encode_many, limit
        self.first, self.later = {}, {}

    def _learn(self, known, wanted, lead):
        """Add the wanted words to a store. One that would grow too large is emptied before and learns them all."""
        words = {w for w in wanted() if w not in known}
        if len(known) + len(words) > self.limit:
            known.clear()
            words = set(wanted())
        plain = [w for w in words if w and not w[0].isspace()]
        known.update(zip(plain, self.encode_many([lead + w for w in plain])))
        if len(plain) < len(words):
            known.update((w, None) for w in words if not w or w[0].isspace())

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") for t in texts]
        self._learn(self.later, lambda: (w for words in cut for w in words[1:]), " ")
        self._learn(self.first, lambda: (words[0] for words in cut), "")
        later, out = self.later.__getitem__, []
        for text, words in zip(texts, cut):
            try:
                out.append(self.first[words[0]] + b"".join(map(later, words[1:])))
            except TypeError:  # a piece that can't stand alone
                out.append(self.encode_many([text])[0] if text else b"")
        return out
