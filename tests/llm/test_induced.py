"""External induced sorting against sorted lists."""
import random

from salesmart.llm import induced


def brute(s):
    """(position, common prefix with the next larger suffix), largest first."""
    n, out, prev = len(s), [], None
    for i in sorted(range(n + 1), key=lambda i: list(s[i:]), reverse=True):
        m = 0
        while prev is not None and max(i, prev) + m < n and s[i + m] == s[prev + m]:
            m += 1
        out.append((i, m))
        prev = i
    return out


def test_suffixes_and_common_prefixes(tmp_path):
    rnd = random.Random(1)
    for _ in range(600):
        k = rnd.choice([1, 2, 3, 26])
        s = [rnd.randrange(k) for _ in range(rnd.randrange(40))]
        if rnd.random() < 0.3:
            s = (s * 3)[:60]
        assert list(induced.suffixes(s, str(tmp_path), rnd.choice([4, 1000]))) == brute(s)


def test_text_larger_than_the_queues_spills_and_cleans_up(tmp_path):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abc") for _ in range(5)) for _ in range(20)]
    text = " ".join(rnd.choice(words) for _ in range(1500)).encode()
    assert list(induced.suffixes(text, str(tmp_path), 64)) == brute(text)
    assert not list(tmp_path.iterdir())


def test_queue_orders_across_runs(tmp_path):
    rnd = random.Random(3)
    q, want, got = induced.DiskQueue(str(tmp_path), 16), [], []
    for _ in range(3000):
        if want and rnd.random() < 0.4:
            got.append(q.pop() == want.pop(0))
        else:
            item = (rnd.randrange(50), rnd.random())
            q.push(item)
            want = sorted([*want, item])
    assert all(got) and len(q) == len(want)
