import random

from tests.llm import brute, odd
from tristrata.llm import personal_data


def checked(spark, rows):
    found = personal_data.find(odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])).collect()
    assert len(found) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(brute.personal_data(t))
    for r in found:
        counts, digest, spans = next(w for w in want[r.doc_id] if w[1] == r.base_sha256)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert set(spans) <= set(filter(None, r.spans.split(",")))
        assert bool(r.added_probability) == (len(spans) < len(list(filter(None, r.spans.split(",")))))
    return {r.doc_id: r for r in found}


def test_base_spans_equal_brute_force(spark):
    rnd = random.Random(3)
    pieces = ["1", "2.", "3.4.5.6", "@", "a", "b.c", "_", "+1 ", "(555) ", "555-1234", " ", "-", "é", "🙂",
              "4111111111111111", "x@y.com", ".", "%", "\n", "300.1.1.1", "007.1.2.3"]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randrange(30)))) for i in range(1500)]
    rows += [(5000 + i, t) for i, t in enumerate([
        None, "", "a" * 60000, "1" * 30000, "1 " * 20000, "a@b@c.d.e", "a@b.com_foo@c.org",
        "1.2.3.4.5.6.7.8.9", "+1" * 2000, "x@" + "a." * 8000, "a@" * 20000,
    ])]
    checked(spark, rows)


def test_swallowed_items_are_added(spark):
    """A phone number and a card number in one run fail the base checks as one."""
    clean = [(i, f"call +1 ({200 + i}) 555-01{i:02d} soon") for i in range(40)]
    cards = [(100 + i, "card 4111111111111111 here") for i in range(40)]
    found = checked(spark, [*clean, *cards, (999, "to +1 (269) 555-3296 4111111111111111 end"), (998, "number 4111111111111112 4111111111111112")])
    assert found[999].spans == "phone:3:20,card:21:37"
    assert found[998].spans == ""


def test_odd_and_empty_documents(spark):
    assert personal_data.find(odd.documents(spark)).count() == len(odd.ROWS)
    assert personal_data.find(odd.documents(spark, [])).count() == 0


def test_estimation_finds_the_unreliable_labeler():
    """Four labelers that agree, and one that votes at random."""
    rnd = random.Random(1)
    patterns = {}
    for _ in range(3000):
        truth = rnd.random() < 0.3
        vote = [(1 if truth else -1) if rnd.random() < 0.9 else (-1 if truth else 1) for _ in range(4)]
        key = "card", (*vote, rnd.choice([1, -1]))
        patterns[key] = patterns.get(key, 0) + 1
    model = personal_data.estimate(patterns)
    assert abs(model.prior["card"] - 0.3) < 0.05
    assert all(abs(model.share["card", i, 1, 1] - 0.9) < 0.05 for i in range(4))
    assert abs(model.share["card", 4, 1, 1] - 0.5) < 0.1
