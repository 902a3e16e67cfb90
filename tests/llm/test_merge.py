import os
import random

import pytest

from callcast.llm.merge import common_prefix, front_code, front_decode, merge_runs


def test_common_prefix():
    assert common_prefix(b"abcd", b"abxy") == 2
    assert common_prefix(b"abcd", b"abcd", 2) == 4
    assert common_prefix(b"ab", b"abcd") == 2
    assert common_prefix(b"", b"x") == 0


@pytest.mark.parametrize("seed", range(40))
def test_merge_gives_sorted_strings_and_their_common_prefixes(seed):
    rnd = random.Random(seed)
    runs, everything = [], []
    for r in range(rnd.randint(0, 9)):
        xs = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 8))) for _ in range(rnd.randint(0, 30)))
        everything += xs
        coded = front_code(xs)
        assert [s for s, _ in front_decode(*coded)] == xs
        runs.append([(s, k, r) for s, k in front_decode(*coded)])
    got = list(merge_runs(runs))
    assert [g[0] for g in got] == sorted(everything)
    for a, b in zip(got, got[1:]):
        assert b[1] == len(os.path.commonprefix([a[0], b[0]]))
    assert [(g[0], g[2]) for g in got] == sorted((g[0], g[2]) for g in got)
