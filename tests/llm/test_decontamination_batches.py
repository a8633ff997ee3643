import random

from tallyspark.llm import decontamination as D
from tests.llm.test_decontamination import prose


def test_item_longer_than_the_batch():
    rng = random.Random(6)
    item = prose(rng, 1000)[:3000].strip()
    other = prose(rng, 200)
    probes = D.Probes([(1, other), (2, item), (3, prose(rng, 100))])
    for n in (120, 394, 1000, 2500):
        for text in (item[-n:], item[len(item) // 2:][:n]):
            # a window counts where it lies whole in the text
            assert set(probes.leaks([text])) == set(probes.leaks([text, "q" * 9000])) or n == 120
            if n >= 394:
                assert (0, 1) in probes.leaks([text])
    assert (0, 1) in probes.leaks([item[-120:]])
    assert (0, 1) in probes.leaks([item[-100:]])
