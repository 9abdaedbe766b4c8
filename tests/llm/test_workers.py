"""What a reused Python worker keeps from task to task."""

import random
from array import array

import public_tokenizers

from shardcraft.llm import common, jaccard, packing, substring
from shardcraft.llm.queries import WORD_TOKENIZER


def test_a_worker_keeps_one_operators_cache_until_anothers_task_runs():
    path = public_tokenizers.path(WORD_TOKENIZER)
    cache = packing.worker_cache(path)
    assert packing.worker_cache(path) is cache
    for run in (jaccard._emit(5, 80, 100), jaccard._vectors(5), substring._emit_runs(20), substring._strip(20)):
        cache = packing.worker_cache(path)
        common.powers(1 << 16)
        assert list(run(iter([]))) == [] and not common._KEPT and not common._POW
        assert packing.worker_cache(path) is not cache
    common.kept(("another",), dict)
    assert list(common._KEPT) == [("another",)]
    common.let_go()


def test_a_batch_of_long_texts_is_split_some_at_a_time(monkeypatch):
    import pyarrow as pa

    cache, most = packing.WordCache(public_tokenizers.path(WORD_TOKENIZER)), []
    ids_of = cache.ids_of
    monkeypatch.setattr(cache, "ids_of", lambda texts: most.append(sum(map(len, texts))) or ids_of(texts))
    texts = [f"word{i} " * 2000 for i in range(200)]
    assert list(packing._ids(cache, pa.array(texts))) == [ids_of([t])[0] for t in texts]
    assert max(most) < (1 << 19) + 20_000


def test_plain_pre_tokens_go_to_the_model_alone_and_each_distinct_one_once(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_TOKENIZER)
    tok, cache = Tokenizer.from_file(path), packing.WordCache(path, limit=100)
    slow, learnt, rng = [], [], random.Random(5)
    encoded, learn = cache._encoded, cache._learn
    monkeypatch.setattr(cache, "_encoded", lambda texts: slow.extend(texts) or encoded(texts))
    monkeypatch.setattr(cache, "_learn", lambda unseen: learnt.extend(unseen) or learn(unseen))
    plain = ["".join(rng.choices("abÀéßÿQZ07.,-<>\n\t ", k=60)) for _ in range(200)]
    assert [list(array("I", g)) for g in cache.ids_of(plain)] == [tok.encode(t, add_special_tokens=False).ids for t in plain]
    assert not slow and len(learnt) == len(set(learnt))          # went through normalizer and pattern before
    signs = [*"ab01 \n\x0b\x1c\x1f\x00\x02\x85\xa0\u2003\u3000\u0301\u0323ÀàŁıİ×÷'|<>中😀²", "<|endoftext|>", "<|ENDOFTEXT|>", "</w>", "'ll"]
    odd = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(2000)]
    for _ in range(2):
        assert [list(array("I", g)) for g in cache.ids_of(odd)] == [tok.encode(t, add_special_tokens=False).ids for t in odd]
    monkeypatch.setattr(cache, "plain", None)                    # a tokenizer not known to work so: a mark parts pre-tokens
    cache.young, cache.old = {}, {}
    assert cache.ids_of(plain) == [encoded([t])[0] for t in plain]
