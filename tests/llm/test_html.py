"""Main text of pages laid out in many ways, none of them a training layout."""

import numpy as np
import pandas as pd
import pytest

from lakeops.llm import html as H

SF = "/root/testdata/sf0.01"

S = ["The harbour froze over in the second week of January, and the ferries stopped running for nine days.",
     "Old people in the town could not remember such a winter, although the church records mention two of them.",
     "Supplies came by sledge from the mainland, pulled by horses which had to rest every few hundred metres.",
     "When the ice broke at last, everybody ran down to the quay to watch the first boat come in."]
T = "The winter of the sledges"
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/c'>Contact</a></li></ul></nav>"
FOOT = "<footer><p>&copy; 2020 The Paper. All rights reserved.</p><a href='/t'>Terms</a></footer>"


def P(xs, t="p"):
    return "".join(f"<{t}>{x}</{t}>" for x in xs)


def pg(b):
    return f"<html><head><title>x</title></head><body>{NAV}{b}{FOOT}</body></html>"


LAYOUTS = {
    'article': pg(f"<article><h1>{T}</h1>{P(S)}</article>"),
    'two sections': pg(f"<article><h1>{T}</h1><section><h2>One</h2>{P(S[:2])}</section><section><h2>Two</h2>{P(S[2:])}</section></article>"),
    'bare body': pg(f"<h1>{T}</h1>{P(S)}"),
    'article divs': pg(f"<article><h1>{T}</h1>{P(S,'div')}</article>"),
    'div noclass': pg(f"<div><h1>{T}</h1>{P(S)}</div>"),
    'div wrap': pg(f"<div><div><h1>{T}</h1><div>{P(S)}</div></div></div>"),
    'div content': pg(f"<div class='content'><h1>{T}</h1>{P(S)}</div>"),
    'main section': pg(f"<main><section><h1>{T}</h1>{P(S)}</section></main>"),
    'main article': pg(f"<main><article><header><h1>{T}</h1></header>{P(S)}</article></main>"),
    'table in': pg(f"<article><h1>{T}</h1>{P(S[:2])}<table><tr><th>Year</th><th>Days of ice</th></tr><tr><td>1784</td><td>31</td></tr><tr><td>1830</td><td>27</td></tr></table>{P(S[2:])}</article>"),
    'figcaption': pg(f"<article><h1>{T}</h1>{P(S[:2])}<figure><img src='x'><figcaption>The frozen harbour in January, seen from the church tower.</figcaption></figure>{P(S[2:])}</article>"),
    'link p': pg(f"<article><h1>{T}</h1>{P(S[:2])}<p><a href='/z'>The complete list of all winters since 1700 is kept in the archive.</a></p>{P(S[2:])}</article>"),
    'body div ps': pg(f"<div id='wrapper'><div class='col'><h2>{T}</h2>{P(S)}</div></div>"),
    'table layout': f"<html><body><table><tr><td>{NAV.replace('nav','div')}</td><td><h1>{T}</h1>{P(S)}</td></tr></table>{FOOT}</body></html>",
    'list': pg(f"<article><h1>{T}</h1><ul>{P(S,'li')}</ul></article>"),
    'h+div+sidebar': pg(f"<div><h1>{T}</h1>{P(S,'div')}</div><aside><h3>Latest news</h3><ul><li><a href='/1'>A dog was found</a></li><li><a href='/2'>Rain expected on Sunday</a></li></ul></aside>"),
    'pre': pg(f"<article><h1>{T}</h1>{P(S[:2])}<pre>for x in y: print(x)</pre>{P(S[2:])}</article>"),
    'dl': pg(f"<main><h1>{T}</h1><dl><dt>Ice</dt><dd>{S[0]}</dd><dt>Town</dt><dd>{S[1]}</dd></dl>{P(S[2:])}</main>"),
    'br': pg(f"<article><h1>{T}</h1>{'<br><br>'.join(S)}</article>"),
    'math': pg(f"<article><h1>{T}</h1>{P(S[:2])}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given.</p>{P(S[2:])}</article>"),
    'comments': pg(f"<article><h1>{T}</h1>{P(S)}</article><section class='comments'><h3>Comments</h3><div class='comment'><b>Joe</b><p>I remember that winter very well, we skated to school every single day.</p></div></section>"),
    'comments in': pg(f"<article><h1>{T}</h1>{P(S)}<div class='comments'><div class='comment'><b>Joe</b><p>I remember that winter very well, we skated to school every single day.</p></div></div></article>"),
}
BOILERPLATE = ["Home","All rights reserved","Terms","Joe","skated to school","Rain expected","Latest news"]
ALSO = {'table in':["1784","Days of ice"],'figcaption':["The frozen harbour"],'link p':["The complete list"],'pre':["for x in y"],'math':["x=2"],'two sections':["One","Two"],'dl':["Ice"]}


@pytest.fixture(scope="module", params=["spread", "first"])
def model(request):
    pages = pd.read_parquet(f"{SF}/pages.parquet").sort_values("page_id")
    sample = pages.iloc[::2] if request.param == "spread" else pages
    x, y = H.training_rows(sample.html.head(H.SAMPLE).tolist())
    return H.fit(x, y, np.ones(len(y)))


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(model, name):
    text = H.main_text(LAYOUTS[name], model)
    assert [x for x in [T, *S, *ALSO.get(name, [])] if x not in text] == []
    assert [x for x in BOILERPLATE if x in text] == []


def test_without_pages_to_learn_from():
    x, y = H.training_rows([])
    model = H.fit(x, y, np.ones(len(y)))
    lost = [k for k, page in LAYOUTS.items() if any(x not in H.main_text(page, model) for x in S)]
    assert set(lost) <= {"bare body"}


def test_page_elements_are_always_mixed():
    tree = H.parse("<html><body><p>a</p><div>b</div></body></html>")
    at = {t: i for i, t in enumerate(tree.tag)}
    raw = np.full(len(tree.tag), -9.0)
    raw[at["p"]] = 0.5
    keep = H.decode(tree, raw)
    assert keep[at["p"]] and not keep[at["div"]]
