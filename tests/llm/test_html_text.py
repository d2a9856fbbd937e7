import numpy as np
import pytest

from stormgrid.llm.html_text import Labeller, blocks, label_blocks, sequence, silver_labels, train


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html, wanted", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p> a \n b<br>c </p>", ["a b c"]),
    ("<p>x &amp; y &eacute; &#233; &lt;b&gt;</p>", ["x & y é é <b>"]), ("<p><b>a<br><p>b</b> c", ["a", "b c"]),
    ("<script>var t='</p>';</script><style>p{}</style><p>a</p>", ["a"]), ("<!-- x --><p>a<!-- y -->b</p>", ["ab"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<p>a <i>b</i><a href=x>c</a></p>", ["a bc"]),
    ("<title>t</title><body>a", ["a"]), ("<p>a</div></p>b</x>", ["a", "b"]), ("a<", ["a<"]), ("<p>unclosed <b", ["unclosed"]),
])
def test_blocks(html, wanted):
    assert texts(html) == wanted


@pytest.mark.parametrize("html, wanted", [
    ("<html><head><title>t</title><body><p>a</p></body></html>", ["a"]),
    ("<head><meta charset=x><title>t</title>\n<link href=y>\n<p>a<p>b", ["a", "b"]),
    ("<head><title>t</title><b>a</b> c", ["a c"]), ("<head><title>t</title> a", ["a"]),
    ("<head><noscript><img src=x>n</noscript><script>s</script><body>a", ["a"]),
    ("<head><template><div>n</div></template><title>t</title></head><p>a", ["a"]),
])
def test_head_without_end(html, wanted):
    assert texts(html) == wanted
    assert all("head" not in b.path for b in blocks(html))


@pytest.mark.parametrize("html, wanted", [
    ("<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> holds</p>", ["E = mc2 holds"]),
    ("<p><math><semantics><mi>x</mi><annotation encoding=tex>\\x</annotation></semantics></math>y</p>", ["xy"]),
    ("<p>a <object data=x>plain <b>words</b></object> b</p>", ["a plain words b"]),
    ("<p>a<canvas id=c> drawn </canvas>b</p>", ["a drawn b"]),
    ("<object><p>a</p></object>b", ["a", "b"]),
])
def test_formulas_and_fallback_texts_stay(html, wanted):
    assert texts(html) == wanted


def test_silver_labels_follow_names():
    page = blocks("<nav>n</nav><article><h1>t</h1><p>x</p><div class='comments'><p>c</p></div></article><footer>f</footer>")
    assert silver_labels(page) == [False, True, True, False, False]


def test_gradients_by_differences():
    page = blocks("<nav>menu</nav><article><p>some text</p><p>and more, yes</p></article>")
    rng = np.random.default_rng(0)
    model = Labeller.fresh(rng)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    pages, labels = [sequence(page), sequence(page[:2])], [np.array([0, 1, 1.0]), np.array([0, 1.0])]
    grad = model.gradients(pages, labels)

    def loss():
        p = np.concatenate(model.probabilities(pages))
        y = np.concatenate(labels)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name in ("xl", "hr", "bl", "out", "bias", "path"):
        flat = model.w[name].reshape(-1)
        i = int(np.abs(grad[name]).argmax())
        old = flat[i]
        ends = []
        for step in (1e-2, -1e-2):
            flat[i] = old + step
            ends.append(loss())
        flat[i] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(grad[name].reshape(-1)[i], rel=0.05, abs=1e-4), name


def page(i, kind="article"):
    body = "".join(f"<p>The text of part {k} of page {i} goes on, and says a little more than menus do.</p>" for k in range(4))
    return (f"<html><head><title>x</title></head><body><nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></nav>"
            f"<div class='ad'>Buy {i} now</div><{kind}><h1>Title {i}</h1>{body}</{kind}><footer>&copy; {i}</footer></body></html>")


def test_labels_pages_not_seen(spark):
    rows = [(i, page(i), "u") for i in range(60)] + [(100, None, "u"), (101, "", "u"), (102, "<p>", "u"), (0, page(0), "u")]
    found = label_blocks(spark.createDataFrame(rows, "page_id long, html string, blocks string"), fit_pages=40)
    out = found.collect()
    assert len(out) == len(rows)
    for r in out:
        kept = [b["text"] for b in r["blocks"] if b["probability"] >= 0.5]
        assert len(kept) == (5 if r["page_id"] < 100 else 0)


def test_context_and_containers_it_was_not_told_of():
    model = train([page(i) for i in range(60)])
    other = page(7, "main").replace("<footer>", "<section id='comments'><p>Nice one, thanks a lot for that.</p></section><footer>")
    kept = [b.text for b, p in zip(blocks(other), model.probabilities([sequence(blocks(other))])[0]) if p >= 0.5]
    assert kept == [b.text for b in blocks(page(7))][3:8]


def test_empty_table(spark):
    assert label_blocks(spark.createDataFrame([], "page_id long, html string")).count() == 0
