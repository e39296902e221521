"""New parts are encoded many at a time, with the ids that whole texts have."""

import numpy as np
import pyarrow as pa

from freightmart.llm import packing, pieces


def test_new_parts_are_encoded_together():
    packing._encoders.clear()
    encoder = packing.encoder(packing.vocabulary())
    texts = ["", " ", "a", " lead", "one two,three  four", "x\n y\t z", "нет ü 世界 🙂 end", "a <|endoftext|> b", "tail "]
    texts += [" ".join(f"w{i}-{j}" for j in range(50)) for i in range(100)]
    calls, batch = [], encoder.batch
    encoder.batch = lambda parts: calls.append(len(parts)) or batch(parts)
    made = encoder.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, made, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    # only odd texts and the texts' first parts go one by one
    assert sum(calls) <= 2 * len(texts)
    packing._encoders.clear()


class Recorder:
    def __init__(self, tokenizer):
        self.tokenizer, self.longest = tokenizer, 0

    def encode_batch_fast(self, texts, add_special_tokens):
        self.longest = max([self.longest, *(t.count(" ") for t in texts)])
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def test_joined_texts_are_short():
    packing._encoders.clear()
    encoder = packing.encoder(packing.vocabulary())
    encoder.tokenizer = Recorder(encoder.tokenizer)
    text = " ".join(f"w{i}" for i in range(3000))
    made = encoder.encode(pa.array([text]))
    assert np.frombuffer(made[0], "<u4").tolist() == encoder.tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
    assert 1 < encoder.tokenizer.longest <= 200
    packing._encoders.clear()


def test_new_parts_of_pieces_are_encoded_together():
    import sentencepiece

    own, other = pieces.PieceCodec(pieces.model_file()), sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())
    texts = ["", " ", "a", " lead", "one two,three  four", "x\n y\t z", "нет ü 世界 🙂 end", "a ▁b ▁", "tail ", "\u0000 \u0007 \U0010ffff", "<unk> <s> <0x41>"]
    texts += [" ".join(f"w{i}-{j}" for j in range(50)) for i in range(100)]
    calls, batch = [], own.parts.batch
    own.parts.batch = lambda parts: calls.append(len(parts)) or batch(parts)
    for text, ids in zip(texts, own.encode(pa.array(texts, pa.string())), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode(text), text
    assert sum(calls) < 1000
    # with the dummy prefix every text's first part begins with a space, too
    calls.clear()
    own.encode(pa.array([" ".join(f"v{i}-{j}" for j in range(50)) for i in range(100)]))
    assert sum(calls) <= 100
