"""The labelled table for the tree of ``html_text``: blocks of invented pages, 1 for article, 0 for the rest.

In the pages ``{n}`` stands for a sentence of n words and ``[n]`` for n words without a full stop.
"""

from __future__ import annotations

import re

_WORDS = "one two three four five six seven eight nine ten".split()

PAGES = [
    # marked article between marked surroundings
    (
        "<head><title>[4]</title></head><body><nav><ul><li><a>[1]</a></li><li><a>[1]</a></li><li><a>[2]</a></li></ul></nav>"
        "<div class='ad'>{8}</div><article><h1>[6]</h1><p>{40}</p><p>{3}</p><p>{1}</p><p>{25} <a>[2]</a> {9}</p><p>{60}</p></article>"
        "<footer>[9]</footer></body>",
        "0 0 0 0 1 1 1 1 1 1 0",
    ),
    (
        "<body><header><a>[2]</a><div>[7]</div></header><main><h1>[5]</h1><p>{12}</p><h2>[3]</h2><ul><li>{5}</li><li>[2]</li>"
        "<li>{14}</li></ul><blockquote>{20}</blockquote><p>{2}</p></main><aside><h3>[2]</h3><p>{18}</p><p>{30}</p></aside>"
        "<footer><p>{22}</p><a>[1]</a></footer></body>",
        "0 0 1 1 1 1 1 1 1 1 0 0 0 0 0",
    ),
    (
        "<body><div id='menu'><a>[1]</a> <a>[1]</a> <a>[2]</a></div><div class='content'><h1>[8]</h1><p>{33}</p><p>{41}</p>"
        "<form><label>[2]</label><p>{12}</p></form><p>{17}</p><div class='comments'><h3>[1]</h3><p>{24}</p><p>{35}</p></div></div>"
        "<div class='sidebar'><p>{28}</p></div></body>",
        "0 1 1 1 0 0 1 0 0 0 0",
    ),
    (
        "<body><div class='cookie-notice'>{16}</div><article><header><h1>[7]</h1><p>{5}</p></header><p>{50}</p><p>{4}</p>"
        "<table><tr><td>[1]</td><td>[2]</td></tr><tr><td>[1]</td><td>{6}</td></tr></table><p>{70}</p></article>"
        "<section id='comments'><article><p>{45}</p></article><article><p>{12}</p></article></section><footer>{30}</footer></body>",
        "0 1 1 1 1 1 1 1 1 1 0 0 0",
    ),
    # text beside a marked article is not part of it
    (
        "<body><p>{14}</p><div><a>[3]</a></div><article><p>{3}</p><p>{26}</p></article><div>{19}</div><p>{36}</p></body>",
        "0 0 1 1 0 0",
    ),
    (
        "<body><div>[3]</div><ul><li><a>[2]</a></li><li><a>[1]</a></li></ul><main><p>{7}</p><p>{2}</p><p>{1}</p><p>{9}</p></main>"
        "<div>{11}</div><div><a>[2]</a> <a>[2]</a></div></body>",
        "0 0 0 1 1 1 1 0 0",
    ),
    # link lists inside the marked part
    (
        "<body><div class='post'><h1>[5]</h1><p>{48}</p><p><a>[9]</a></p><p>{52}</p><ul><li><a>[3]</a></li><li><a>[2]</a></li>"
        "<li><a>[4]</a></li><li><a>[3]</a></li></ul></div></body>",
        "1 1 1 1 0 0 0 0",
    ),
    (
        "<body><article><ul><li><a>[1]</a></li><li><a>[1]</a></li><li><a>[2]</a></li><li><a>[1]</a></li></ul><h1>[4]</h1><p>{30}</p>"
        "<p>{22}</p><p><a>[5]</a></p><p>{31}</p></article></body>",
        "0 0 0 0 1 1 1 1 1",
    ),
    # no marks: density and neighbours decide
    (
        "<body><div><a>[1]</a> | <a>[1]</a> | <a>[1]</a></div><div>[3]</div><h1>[6]</h1><p>{35}</p><p>{60}</p><p>{4}</p><p>{28}</p>"
        "<div><a>[2]</a></div><div><a>[3]</a></div><div>[7]</div></body>",
        "0 0 1 1 1 1 1 0 0 0",
    ),
    (
        "<body><table><tr><td><a>[1]</a></td><td><a>[2]</a></td><td><a>[1]</a></td></tr><tr><td><p>{45}</p><p>{33}</p><p>{20}</p>"
        "<p>{52}</p></td></tr><tr><td><a>[2]</a></td><td>[5]</td></tr></table></body>",
        "0 0 0 1 1 1 1 0 0",
    ),
    (
        "<body><div><a>[2]</a></div><div><a>[1]</a></div><div><h2>[4]</h2><div>{22}</div><div>{41}</div><div>{6}</div><div>{39}</div>"
        "</div><div><a>[4]</a></div><div><a>[3]</a></div><div><a>[3]</a></div><div>[6]</div></body>",
        "0 0 1 1 1 1 1 0 0 0 0",
    ),
    (
        "<body><a>[1]</a><p>{18}</p><p>{55}</p><p>{24}</p><p><a>[6]</a> {19}</p><p>{47}</p></body>",
        "0 1 1 1 1 1",
    ),
    ("<body><h1>[3]</h1><p>{15}</p><p>{21}</p></body>", "1 1 1"),
    ("<body><p>{80}</p></body>", "1"),
    ("{44}", "1"),
    ("<body><article><p>{2}</p></article></body>", "1"),
    # short articles: marked ones count whatever their length
    ("<body><nav><a>[1]</a></nav><div>{9}</div><article><h1>[4]</h1><p>{4}</p></article><footer>[7]</footer></body>", "0 0 1 1 0"),
    ("<body><div>{12}</div><article><h1>[2]</h1><p>[3]</p><p>[1]</p></article><div>[9]</div></body>", "0 1 1 1 0"),
    ("<body><div>[2]</div><main><p>[5]</p><p>[2]</p></main><p>{14}</p></body>", "0 1 1 0"),
    ("<body><nav><a>[1]</a><a>[1]</a></nav><article><h1>{6}</h1></article><footer>{12}</footer></body>", "0 1 0"),
    ("<body><article><h1>[7]</h1><p>[7]</p></article></body>", "1 1"),
    ("<body><article><p>[1]</p><p>{3}</p><p>[6]</p></article><div>[3]</div><div>{5}</div></body>", "1 1 1 0 0"),
    ("<body><div><a>[1]</a></div><div class='entry'><p>{8}</p><p>[2]</p><pre>[4]</pre></div><div>[4]</div></body>", "0 1 1 1 0"),
    # marked articles that start or end the page, some of them broken off
    ("<body><nav><a>[1]</a></nav><article><h1>[4]</h1><p>{30}</p><p>[12]", "0 1 1 1"),
    ("<body><main><p>[3]</p><p>{50}</p><p>[7]</p></main></body>", "1 1 1"),
    ("<article><p>[4]</p><p>{60}</p><p>[2]</p>", "1 1 1"),
    ("<body><main><div>[5]</div><p>{33}</p><ul><li>[2]</li><li>[3]</li><li>[8]</li></ul></main></body>", "1 1 1 1 1"),
    ("<article><p>[9]", "1"),
    ("<body><article><p>[2]</p><p>{25}</p><p>[5]", "1 1 1"),
    ("<body><article><p>[1]</p><p>[6]</p><p>[3]</p></article></body>", "1 1 1"),
    # short unmarked pages, and long blocks without a full stop
    ("<body><div>[2]</div><p>[45]</p><p>{30}</p><p>[38]</p><div>[5]</div></body>", "0 1 1 1 0"),
    ("<body><div>[3]</div><h1>[4]</h1><p>[60]</p><p>[25]</p><p>{40}</p><div>[7]</div></body>", "0 1 1 1 1 0"),
    ("<body><p>{5}</p></body>", "1"),
    ("<body><h1>[3]</h1><p>{7}</p></body>", "1 1"),
    ("<body><h1>[5]</h1><p>{30}</p><p>{2}</p><p>{26}</p><div>[6]</div></body>", "1 1 1 1 0"),
    ("<body><div>[2]</div><p>{40}</p><p>{35}</p><p>{3}</p><p>{20}</p><div>[5]</div></body>", "0 1 1 1 1 0"),
    ("<body><div><a>[1]</a></div><div>[4]</div><p>{27}</p><h2>[3]</h2><p>{31}</p><div>[8]</div><a>[2]</a></body>", "0 0 1 1 1 0 0"),
    ("<body><ul><li><a>[1]</a></li><li><a>[2]</a></li><li><a>[2]</a></li></ul><div>[4]</div></body>", "0 0 0 0"),
    (
        "<body><nav><a>[1]</a></nav><div><h1>[5]</h1><p>{30}</p><p>{44}</p><p>{16}</p></div><div class='related'><a>[6]</a><p>{12}</p>"
        "</div><div class='newsletter'><p>{20}</p></div><footer>[8]</footer></body>",
        "0 1 1 1 1 0 0 0 0",
    ),
    # wrappers whose names tell of what else they hold, forms round a page, names that only set a style
    (
        "<body><nav><a>[1]</a></nav><div class='content-sidebar-wrap'><main><h1>[4]</h1><p>{30}</p><p>{22}</p></main>"
        "<div class='sidebar'><p>{25}</p></div></div><footer>[8]</footer></body>",
        "0 1 1 1 0 0",
    ),
    (
        "<body><div class='layout has-sidebar'><div><h1>[4]</h1><p>{33}</p><p>{24}</p><p>{18}</p></div><div class='sidebar'><p>{28}</p>"
        "</div></div></body>",
        "1 1 1 1 0",
    ),
    (
        "<body><nav><a>[1]</a></nav><div class='post no-comments'><h1>[5]</h1><p>{36}</p><p>{4}</p><p>{21}</p></div>"
        "<div class='related'><p>{30}</p></div></body>",
        "0 1 1 1 1 0",
    ),
    (
        "<body><form id='form'><nav><a>[2]</a></nav><div><h1>[5]</h1><p>{42}</p><p>{26}</p><p>{31}</p></div><div class='search'>{3}</div>"
        "<div>[4]</div></form></body>",
        "0 1 1 1 1 0 0",
    ),
    (
        "<body><nav><a>[1]</a></nav><p class='text-center'>{3}</p><div><h1>[4]</h1><p>{40}</p><p>{27}</p><p>{25}</p></div>"
        "<div class='text-muted'>[4]</div></body>",
        "0 0 1 1 1 1 0",
    ),
    (
        "<body><div><h1>[4]</h1><p>{34}</p><p>{29}</p><p>{38}</p></div><div class='comments'><p>{24}</p><p>{55}</p><p>{19}</p></div>"
        "<div class='sidebar widget'><p>{48}</p></div></body>",
        "1 1 1 1 0 0 0 0",
    ),
    (
        "<body><div><h1>[4]</h1><p>{37}</p><p>{28}</p><p>{33}</p></div><div class='text-muted'>[4]</div><div class='sidebar'>"
        "<p>{24}</p></div></body>",
        "1 1 1 1 0 0",
    ),
    (
        "<body><nav><a>[1]</a></nav><div><h1>[3]</h1><p>{26}</p><p>{39}</p></div><div class='text-small'>[3]</div><div class='widget'>"
        "<p>{17}</p></div></body>",
        "0 1 1 1 0 0",
    ),
]


def _words(n: int) -> str:
    return " ".join(_WORDS[i % len(_WORDS)] for i in range(n))


def labelled_blocks() -> list[tuple[str, list[int]]]:
    """(page, label of each of its blocks)."""
    out = []
    for page, labels in PAGES:
        text = re.sub(r"\{(\d+)\}", lambda m: _words(int(m[1])) + ".", page)
        text = re.sub(r"\[(\d+)\]", lambda m: _words(int(m[1])), text)
        out.append((text, [int(x) for x in labels.split()]))
    return out
