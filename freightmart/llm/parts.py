"""Whole texts through a tokenizer, with every distinct part encoded once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts whose ids a Python worker remembers before it forgets all and starts again.
CACHE_PARTS = 600_000
#: Bytes of text encoded together.
ENCODE_BYTES = 2 << 20
#: New parts encoded as one text. Longer texts cost more a byte: 200 take 11.5 s for the texts of sf0.1 where 2,000 take 15.7 s.
JOINED = 200


class PartEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to the tokenizer's own.

    For tokenizers whose pieces never reach from a visible character over a space: there a text can be cut before every
    space, parts are encoded on their own, and one seen before needs no second encoding. Texts in which the pattern
    ``odd`` is found, or a token of ``special``, go through the tokenizer whole.
    """

    def __init__(self, tokenizer, odd: str, special: list[str], unknown: int | None = None, byte_ids: list[int] | None = None,
                 sizes: np.ndarray | None = None):
        """With ``byte_ids`` the text of an ``unknown`` token becomes the ids of its bytes.

        ``sizes`` tells how many bytes of text each id stands for; with it new parts are encoded many at a time, as one text.
        """
        self.tokenizer, self.odd, self.special = tokenizer, odd, special
        self.unknown, self.byte_ids = unknown, byte_ids
        self.sizes = sizes if not any(" " in token for token in special) else None
        self.known: dict[str, bytes] = {}

    def ids(self, encoding) -> list[int]:
        ids = encoding.ids
        if self.byte_ids is None or self.unknown not in ids:
            return ids
        return [x for i, token in zip(ids, encoding.tokens, strict=True)
                for x in ([i] if i != self.unknown else [self.byte_ids[b] for b in token.encode("utf-8")])]

    def batch(self, texts: list[str]) -> list[bytes]:
        run = self.tokenizer.encode_batch_fast if self.byte_ids is None else self.tokenizer.encode_batch  # only the latter keeps tokens
        return [np.array(self.ids(e), "<u4").tobytes() for e in run(texts, add_special_tokens=False)]

    def learn(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_PARTS:
            self.known.clear()
        made = list(map(self.known.get, parts))
        places = [i for i, ids in enumerate(made) if ids is None]
        new = list(dict.fromkeys([parts[i] for i in places]))
        if self.sizes is None:
            self.known.update(zip(new, self.batch(new), strict=True))
        else:
            # a part without a space before it cannot follow another one
            heads = [p for p in new if p[:1] != " "]
            self.known.update(zip(heads, self.batch(heads), strict=True))
            new = [p for p in new if p[:1] == " "]
            for i in range(0, len(new), JOINED):
                self.known.update(zip(new[i:i + JOINED], self.joined(new[i:i + JOINED]), strict=True))
        for i in places:
            made[i] = self.known[parts[i]]
        return made

    def joined(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that begin with a space, encoded as one text and cut where the bytes of a part end."""
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(p.encode("utf-8")) for p in parts])
        last = np.searchsorted(ends, wanted)
        if last[-1] >= len(ends) or (ends[last] != wanted).any():
            return self.batch(parts)
        raw, cuts = ids.tobytes(), [0, *((last + 1) * 4).tolist()]
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The texts must not be null."""
        odd = pc.match_substring_regex(texts, self.odd)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for i, made in zip(np.flatnonzero(odd).tolist(), self.batch(texts.filter(pa.array(odd)).to_pylist()), strict=True):
            out[i] = made
        parts = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        flat, ends = parts.values.dictionary_encode(), parts.offsets.to_numpy()
        if not len(parts):
            return out
        # a text's first part has no space before it: it gets an entry of its own
        unit = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = flat.dictionary.take(flat.indices.take(pa.array(ends[:-1]))).to_pylist()
        used = np.ones(len(unit), bool)
        used[ends[:-1]] = False
        spaced = np.zeros(len(flat.dictionary), bool)
        spaced[unit[used]] = True
        # entries that only begin texts are left out, and the others numbered anew
        units = pc.binary_join_element_wise(pa.scalar(""), flat.dictionary.filter(pa.array(spaced)), " ").to_pylist()
        unit = (np.cumsum(spaced) - 1)[unit]
        unit[ends[:-1]] = len(units) + np.arange(len(heads))
        units += heads
        made = self.learn(units)
        size = np.fromiter(map(len, made), np.int64, len(made)) // 4
        ids = np.frombuffer(b"".join(made), "<u4")
        first, n = (np.cumsum(size) - size)[unit], size[unit]
        begins = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.arange(begins[-1]) + np.repeat(first - begins[:-1], n)].tobytes()
        rows = (begins[ends] * 4).tolist()
        for i, a, b in zip(np.flatnonzero(~odd).tolist(), rows[:-1], rows[1:], strict=True):
            out[i] = raw[a:b]
        return out
