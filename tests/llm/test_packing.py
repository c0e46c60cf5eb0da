import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from paperloom.llm import packing
from paperloom.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, at int, sequence_id string"


def exact(lengths, capacity):
    """Fewest bins by trying everything."""
    best = [len(lengths)]

    def place(i, free):
        if len(free) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(free)
            return
        for b in range(len(free)):
            if free[b] >= lengths[i] and free[b] not in free[:b]:
                place(i + 1, free[:b] + [free[b] - lengths[i]] + free[b + 1:])
        place(i + 1, free + [capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_bound_and_best_fit_against_the_optimum():
    rng = random.Random(5)
    for _ in range(150):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        least = exact(lengths, 20)
        bins, offsets, free = packing.best_fit_decreasing(np.array(lengths), 20)
        bound = packing.lower_bound(np.array(lengths), np.ones(len(lengths), int), 20)
        assert bound <= least <= len(free) and (free >= 0).all()
        for b in range(len(free)):
            inside = sorted((o, n) for o, n, x in zip(offsets, lengths, bins) if x == b)
            assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside])[:-1].tolist()


def test_cut_pieces():
    assert packing.cut(0, 8) == [] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_ids_equal_those_of_the_whole_text():
    rng = random.Random(2)
    odd = ["a\x1c b", "\x1c b c", " \n\n x", "it's 'twas we'll", "日本語 テスト", "x<|endoftext|>y", "\x85 a\x85", "  ", "12 345\t\n a", "x" * 300 + " " + "y" * 300]
    odd += ["".join(rng.choice("ab \n\t\x1c\x1f  é1'!　śÉ") for _ in range(50)) for _ in range(500)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        for _ in range(2):
            with encoder(public_tokenizers.path(name)) as ours:
                for text in odd:
                    assert ours(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
        ours.timer.cancel()


def test_both_encoders_agree():
    plain = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    tokens = [t for t in (plain.decode([i]) for i in range(50_256)) if "\ufffd" not in t]
    letters = [chr(c) for c in range(0x530)]
    texts = ["".join(rng.choices(tokens, k=40)) for _ in range(3000)] + ["".join(rng.choices(letters, k=60)) for _ in range(1500)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(300)] + [" " * n + "x" for n in (10, 4999, 5000, 2_000_000)]
    with encoder(PATH) as ours:
        assert ours.fast is not None
        for text in texts:
            assert ours(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text[:200])
    ours.timer.cancel()


def test_packing_is_whole_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION", 40)
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(["one", "two", "three", "tokenizer"]) for _ in range(rng.randint(0, 150)))) for i in range(300)]
    docs += [(None, None), (7, ""), (7, "twice"), (7, "twice"), (400, "long " * 5000)]
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA)
    packed = packing.pack(rows, PATH, 128, with_ids=True)
    got = packed.collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for d, t in docs:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(d or -1, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 128))]
    assert sorted((-1 if r.doc_id is None else r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _, _ in parts] == np.cumsum([0] + [n for _, n, _ in parts])[:-1].tolist() and sum(n for _, n, _ in parts) <= 128
    bound = packing.lower_bound(np.array([r.length for r in got]), np.ones(len(got), int), 128)
    short = np.array(sorted((r.length for r in got if r.length < 128), reverse=True))
    alone = len(packing.best_fit_decreasing(short, 128)[2]) + sum(r.length == 128 for r in got)
    assert bound <= len(sequences) <= alone + 1
    for r in packing.assemble(packed).collect():
        assert r.ids == [x for _, _, ids in sorted(sequences[r.sequence_id]) for x in ids]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
