"""Documents of small sources are judged by their language, those of small languages by the corpus."""

import random

from daybook.llm import outliers


def _text(rng, n=80, symbol=0.0):
    return " ".join(("#$%" if rng.random() < symbol else "") + "".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def test_small_groups_have_an_estimate(documents, monkeypatch):
    rng = random.Random(1)
    rows = [(i, _text(rng), "en", "big") for i in range(60)] + [(100 + i, _text(rng), "en", "small") for i in range(4)]
    rows += [(200 + i, _text(rng), "xx", "tiny") for i in range(3)] + [(300, _text(rng, symbol=1.0), "en", "small"), (301, _text(rng, symbol=1.0), "xx", "tiny")]
    rows += [(302, _text(rng, symbol=1.0), None, None), (400, "too short", "en", "big")]
    got = {r["doc_id"]: r for r in outliers.judge(documents(rows, extra=("level", "salt", "g"))).collect()}
    assert {r["level"] for i, r in got.items() if i < 100} == {"source"}
    assert {got[i]["level"] for i in (100, 103, 300)} == {"language"} and {got[i]["level"] for i in (200, 301, 302)} == {"corpus"}
    assert not any(got[i]["kept"] for i in (300, 301, 302, 400)) and got[400]["level"] is None
    assert sum(r["kept"] for i, r in got.items() if i < 300) >= 63
    assert all(got[i]["distance"] is not None for i in got if i != 400)


def test_a_group_of_its_own_equals_the_level_above(documents):
    """One source in one language: all three estimates are of the same documents."""
    rng = random.Random(2)
    texts = [_text(rng, n=rng.randint(50, 90), symbol=rng.choice([0, 0, 0.05])) for _ in range(50)]
    distances = []
    for sources in (["a"] * 50, [f"s{i}" for i in range(50)]):
        got = outliers.judge(documents([(i, t, "en", s) for i, (t, s) in enumerate(zip(texts, sources))])).collect()
        assert {r["level"] for r in got} == {"source" if sources[0] == "a" else "language"}
        distances.append({r["doc_id"]: round(r["distance"], 6) for r in got})
    assert distances[0] == distances[1]
