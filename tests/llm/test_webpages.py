"""Pages whose names mislead: nothing of an article is lost, against known texts and a second, slow extractor."""

import random
import re
from html.parser import HTMLParser

import pytest

from corpusloom.llm import webpages

BODY = "<p>" + "body text of a page, " * 30 + "</p>"
TEXT = ("body text of a page, " * 30).strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><div class='entry-header'><h1>T</h1></div>{BODY}</article>", f"T\n{TEXT}"),
        (f"<article><section class='page-header'><h1>T</h1></section>{BODY}</article>", f"T\n{TEXT}"),
        (f"<article><h1 class='article-header'>T</h1>{BODY}</article>", f"T\n{TEXT}"),
        (f"<article><header><h1>T</h1><p>lede</p></header>{BODY}</article>", f"T\nlede\n{TEXT}"),
        (f"<div id='wrap' class='with-sidebar'><h1>T</h1>{BODY}<div class='sidebar'>words on the side, five or more</div></div>", f"T\n{TEXT}"),
        (f"<div id='main-side'><h1>T</h1>{BODY}</div>", f"T\n{TEXT}"),
        (f"<article><p>lede</p><div class='social-policy'>{BODY}</div></article>", f"lede\n{TEXT}"),
        (f"<div><p>intro line one.</p><p>intro two.</p></div><div class='content'>{BODY}</div>", f"intro line one.\nintro two.\n{TEXT}"),
        (f"<div class='sidebar'>{BODY}</div>", TEXT),
        (f"<form>{BODY}</form>", TEXT),
        (f"<form><input><h1>T</h1>{BODY}</form><p class='ad'>an advert of a few words</p>", f"T\n{TEXT}"),
        (f"<aside>{BODY}</aside>", TEXT),
        (f"<div class='page-header'><h1>T</h1></div><div class='content'>{BODY}</div><div class='comments'>{BODY * 3}</div>", f"T\n{TEXT}"),
        (f"<div class='ad'>{BODY}</div><article><h1>T</h1><p>short</p></article>", "T\nshort"),
        (f"<div class='ad'>{BODY}</div><div class='text'><h1>T</h1><p>short</p></div>", "T\nshort"),
        (f"<div class='related-posts-of-ours'><a href='x'>{TEXT}</a></div><div>{BODY}</div>", TEXT),
        (f"<div class='comments'>{BODY}</div>", TEXT),
        (f"<nav>{BODY}</nav>", ""),
        (f"<article>{BODY}<div class='share'>share this</div><div class='newsletter-signup'>your mail address please</div></article>", TEXT),
    ],
)
def test_names_are_signs_only(page, text):
    assert webpages.extract(f"<html><body>{page}</body></html>", []) == text


class Tree(HTMLParser):
    """Well-formed markup as nested [tag, attributes, children]."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.root = ["", {}, []]
        self.open = [self.root]
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        self.open[-1][2].append(node)
        if tag not in ("br", "input"):
            self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][2].append(data)


def every(node):
    for child in node[2]:
        if not isinstance(child, str):
            yield child
            yield from every(child)


def size(node, links=False, inside=False):
    """Characters outside links, or in them."""
    inside = inside or node[0] == "a"
    return sum((len(" ".join(c.split())) if inside == links else 0) if isinstance(c, str) else size(c, links, inside) for c in node[2])


def slow_extract(source):
    """The rules of the module's docstring over a whole tree, each asked anew of each element."""
    root = Tree(source).root
    for node in [root, *every(root)]:
        node[2] = [c for c in node[2] if isinstance(c, str) or c[0] not in ("script", "style", "nav", "aside", "footer", "button", "head")]
    is_main = lambda n: n[0] in ("article", "main")
    holds = lambda n, x: any(y is x for y in every(n))
    mains = [n for n in every(root) if is_main(n)]
    outer = [m for m in mains if not any(holds(o, m) for o in mains)]
    for node in [root, *every(root)]:
        node[2] = [c for c in node[2] if isinstance(c, str) or c[0] != "header" or any(holds(m, c) for m in mains)]
    total, articles = size(root), sum(map(size, outer))
    inline = lambda n: n[0] in ("a", "b", "i", "span", "br", "input")
    solid = lambda n: any(s for _, s, _ in blocks(n))

    def blocks(node):
        """(text, solid, tag) of the runs of text and inline elements of a node, in order."""
        run, plain, out = "", 0, []
        for child in [*node[2], None]:
            if isinstance(child, str) or (child and inline(child)):
                text = child if isinstance(child, str) else "".join(x if isinstance(x, str) else x[2][0] for x in child[2])
                run += text
                plain += 0 if not isinstance(child, str) and child[0] == "a" else len(text.strip())
                continue
            if text := " ".join(run.split()):
                out.append((text, plain > 0 and (node[0] in ("p", "li", "h1", "h2", "h3") or len(text.split()) >= 5), node[0] if plain else ""))
            run, plain = "", 0
            if child:
                out += blocks(child)
        return out

    def kind(node):
        if node[0] == "form":
            return "plain"
        if is_main(node) or node[0] in ("html", "body", ""):
            return None
        kinds = set()
        for name in f"{node[1].get('class', '')} {node[1].get('id', '')}".split():
            words = [w for w in re.split(r"[-_\d]+", name) if w]
            signs = [w for w in words if re.fullmatch("ad|sidebar|side|header|comments?|share|social|related|newsletter|signup|banner|menu", w)]
            if signs and words[0] not in ("no", "without"):
                plain = all(w in signs or w in ("list", "area", "posts", "site", "box", "main") for w in words) and words != ["main", "side"]
                kinds.add("comments" if plain and {"comment", "comments"} & set(signs) else "plain" if plain else "mixed")
        best = next((k for k in ("comments", "plain", "mixed") if k in kinds), None)
        return None if best == "mixed" and node[0] in ("h1", "h2", "h3") else best

    signed = [n for n in every(root) if kind(n)]
    under = lambda n: any(n is s or holds(s, n) for s in signed)

    def rest(node):
        """Whether some solid text is outside of all signs."""
        own = [node[0], node[1], [c for c in node[2] if isinstance(c, str) or inline(c)]]
        return not under(node) and (solid(own) or any(rest(c) for c in node[2] if not isinstance(c, str) and not inline(c)))

    more = rest(root)

    def goes(node):
        what, mass, inside = kind(node), size(node), any(holds(m, node) for m in mains)
        in_mains = sum(size(m) for m in mains if holds(node, m) and not any(holds(o, m) and holds(node, o) for o in mains))
        headed = any(n[0] in ("h1", "h2") for n in every(node)) or node[0] in ("h1", "h2")
        if size(node, True) >= max(mass, 1):
            return True
        if what == "mixed":
            return not inside and not in_mains and not headed and mass < 0.1 * total
        if articles and not inside:
            return what == "comments" or 2 * in_mains < articles
        return what == "comments" or 2 * mass <= total or (more and not headed)

    gone = [n for n in signed if goes(n)]

    def prune(node):
        node[2] = [c for c in node[2] if isinstance(c, str) or not any(c is g for g in gone)]
        for c in node[2]:
            if not isinstance(c, str):
                prune(c)

    prune(root)
    heads = sorted(t for _, _, t in blocks(root) if t in ("h1", "h2", "h3"))
    container = lambda n: n[0] in ("html", "body", "main", "article", "section", "div")

    def parts(node):
        """The nearest containers below."""
        return [x for c in node[2] if not isinstance(c, str) for x in ([c] if container(c) else parts(c))]

    title = next((n for n in every(root) if heads and n[0] == heads[0]), None)
    at = root
    while below := parts(at):
        has_main = lambda n: is_main(n) or any(map(is_main, every(n)))
        best = max(below, key=lambda n: size(n) * (1 + has_main(n)))
        all_there = solid(best) and sum(s for _, s, _ in blocks(best)) == sum(s for _, s, _ in blocks(at))
        if not size(best) or not (all_there or (has_main(best) and size(best) >= webpages.MOST * size(at))):
            break
        inside = is_main(at) or any(holds(m, at) for m in mains)
        if inside and (not has_main(best) or size(best) < size(at) or at[0] == "article"):
            break
        if title and holds(at, title) and not holds(best, title) and not (has_main(best) and any(t in ("h1", "h2", "h3") for _, _, t in blocks(best))):
            break
        at = best
    return "\n".join(t for t, _, _ in blocks(at))


def layouts(draw):
    """(page, its main text) of ten layouts."""
    words = lambda n: " ".join(draw.choice(("stone", "river", "lamp", "road", "winter", "table", "green")) for _ in range(n))
    paragraphs = [words(draw.randrange(12, 60)) for _ in range(draw.randrange(2, 5))]
    body, head, lede = "".join(f"<p>{p}</p>" for p in paragraphs), words(4), words(6)
    text = "\n".join(paragraphs)
    nav = "<nav><ul>" + f"<li><a href='/'>{words(1)}</a></li>" * 4 + "</ul></nav>"
    side = f"<div class='{draw.choice(('sidebar', 'side-box', 'related-posts'))}'><p>{words(8)}</p></div>"
    foot, ad = f"<footer>{words(7)}</footer>", f"<div class='ad'>{words(9)}</div>"
    said = "<div class='comments'>" + f"<div class='comment'><p>{words(40)}</p></div>" * draw.randrange(1, 9) + "</div>"
    yield f"{nav}{ad}<article><h1>{head}</h1>{body}</article>{said}{foot}", f"{head}\n{text}"
    yield f"{nav}<article><div class='entry-header'><h1>{head}</h1></div>{body}<div class='share'>{words(3)}</div></article>{side}", f"{head}\n{text}"
    yield f"<div class='with-sidebar'>{nav}<main><h1>{head}</h1><p>{lede}</p>{body}</main>{side}</div>{foot}", f"{head}\n{lede}\n{text}"
    yield f"{nav}<div id='main-side'><h1>{head}</h1>{body}</div>{said}", f"{head}\n{text}"
    yield f"<article><p>{lede}</p><div class='social-policy'>{body}</div></article>{ad}{foot}", f"{lede}\n{text}"
    yield f"{nav}<div class='intro'><p>{lede}</p></div><div class='content'>{body}</div>{foot}", f"{lede}\n{text}"
    yield f"<form>{nav}<div class='page-header'><h1>{head}</h1></div><div class='content'>{body}</div>{side}</form>", f"{head}\n{text}"
    yield f"<header><h2>{words(2)}</h2></header><section><h1 class='page-header'>{head}</h1><div>{body}</div></section>{side}{said}", f"{head}\n{text}"
    yield f"{ad}<div class='col1'><div class='col2'><h2>{head}</h2>{body}</div></div><div class='menu'><a href='/'>{words(3)}</a></div>", f"{head}\n{text}"
    yield f"<div class='site-header'><p>{words(2)}</p></div><main><article><header><h1>{head}</h1></header>{body}</article></main>{said}{foot}", f"{head}\n{text}"


def test_ten_layouts_by_known_texts_and_a_second_extractor():
    draw = random.Random(4)
    for _ in range(60):
        for page, text in layouts(draw):
            source = f"<html><head><style>x</style></head><body>{page}</body></html>"
            assert webpages.extract(source, []) == text == slow_extract(source), source


def test_no_page_with_text_is_empty():
    draw = random.Random(5)
    names = ("sidebar", "ad", "comments", "no-nav", "with-side", "content", "menu x", "social-policy", "")
    for _ in range(400):
        page = "some words"
        for _ in range(draw.randrange(1, 6)):
            tag = draw.choice(("div", "section", "form", "aside", "footer", "header", "p", "article", "ul"))
            page = f"<{tag} class='{draw.choice(names)}' id='{draw.choice(names)}'>{page}</{tag}>" + draw.choice(("", "<nav>x</nav>", "<script>y</script>"))
        assert webpages.extract(page, []) == "some words", page
