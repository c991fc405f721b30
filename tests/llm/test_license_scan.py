import random

from wardflow.llm import license_scan as L

from .conftest import prose


def by_hand(text, templates, n=L.N):
    """Templates of which some window, widened by a stride, holds enough shingles."""
    w = L.words_of(text or "")
    s = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
    out = {}
    for name, t in templates.items():
        tw = L.words_of(t)
        ts = {tuple(tw[i:i + n]) for i in range(len(tw) - n + 1)}
        width = len(tw) - n + 1
        stride = max(1, width // 8)
        best = max((len(ts & set(s[max(0, i - stride):max(0, i - stride) + width + 2 * stride])) / len(ts) for i in range(0, max(1, len(s) - width + 1), stride)), default=0)
        if best >= L.CONTAINED:
            out[name] = best
    return out


def texts():
    rng = random.Random(4)
    out = []
    for i, (name, t) in enumerate(L.TEMPLATES.items()):
        out += [t, f"{prose(i, 40)}\n{t}\n{prose(i + 50, 30)}", t.upper(), t.replace(" ", "\n * ")]
        w = t.split()
        for _ in range(4):
            cut = list(w)
            if len(cut) > 15:
                cut[rng.randrange(len(cut))] = "changed"
            out.append(prose(rng.randint(0, 99), rng.randint(0, 60)) + " " + " ".join(cut))
        out.append(" ".join(w[: len(w) // 2]))
    return out


def test_by_hand(make_docs, odd_texts):
    rows = list(enumerate(texts() + odd_texts + ["licensed under nothing at all here", prose(1, 200)]))
    got = {}
    for r in L.scan(make_docs([(i, t, None) for i, t in rows])).collect():
        got.setdefault(r["id"], {})[r["license"]] = r["containment"]
    assert got == {i: m for i, t in rows if (m := by_hand(t, L.TEMPLATES))}


def test_repeats_nulls_and_empty_table(make_docs):
    mit = "Released under the MIT License."
    docs = make_docs([(1, mit, None), (1, mit, None), (None, f"x {mit} y {mit}", None), (2, None, None)])
    got = sorted((str(r["id"]), r["license"], r["n_windows"], r["first_word"]) for r in L.scan(docs).collect())
    assert [g[:2] for g in got] == [("1", "MIT"), ("None", "MIT")] and got[1][2] >= 2 and got[0][3] == 0
    assert L.scan(docs.filter("false")).count() == 0


def test_anchors_lose_nothing():
    words = L.anchors(L.TEMPLATES)
    for t in L.TEMPLATES.values():
        w = L.words_of(t)
        every = {tuple(w[i:i + L.N]) for i in range(len(w) - L.N + 1)}
        assert sum(set(s).isdisjoint(words) for s in every) < L.CONTAINED * len(every)


def test_plan_has_no_python(make_docs, spark):
    plan = L.scan(make_docs([(1, "x", None)]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
