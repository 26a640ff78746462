"""Main text of pages of many layouts, marked by hand: what is main text stands in the second place of a part."""

import pytest

from lexiloom.llm import pages

PROSE = {
    "en": ["This is the story of a town by the river, and of the people who have lived in it for as long as anyone can remember. They go to the market in the morning, and they come back home when it is late in the evening.", "It was not until the end of the year that the new bridge was opened, and by that time most of the shops on the other side of the river had been closed for so long that there was no one to ask about them.", "No one knew it."],
    "fr": ["C'est l'histoire d'une ville au bord de la rivière, et de tous les gens qui y vivent depuis que le pont a été construit. Ils vont au marché le matin et ne reviennent à la maison que le soir, avec leurs enfants.", "Ce n'est pas avant la fin de l'année que le pont a été ouvert, et les boutiques de l'autre côté de la rivière étaient alors fermées depuis si longtemps que plus personne ne se souvenait de ce qui y était vendu.", "Il est parti."],
    "de": ["Das ist die Geschichte einer Stadt an dem Fluss und der Leute, die in ihr leben, so lange man sich erinnern kann. Sie gehen am Morgen auf den Markt und kommen erst nach Hause, wenn es am Abend schon dunkel ist.", "Erst am Ende des Jahres ist die neue Brücke eröffnet worden, und die Läden auf der anderen Seite des Flusses sind zu der Zeit schon so lange geschlossen gewesen, dass sich niemand mehr an sie erinnern konnte.", "Er war es nicht."],
    "es": ["Esta es la historia de un pueblo al lado del río y de la gente que ha vivido en él desde que se tiene memoria. Por la mañana van al mercado y no vuelven a su casa hasta que es de noche, con todos sus hijos.", "No fue hasta el final del año cuando se abrió el puente nuevo, y para entonces las tiendas del otro lado del río ya llevaban tanto tiempo cerradas que no había nadie que se acordara de lo que se vendía en ellas.", "No lo era."],
    "ru": ["Это рассказ о городе у реки и о людях, которые живут в нём с незапамятных времён. Каждое утро они идут на рынок за овощами и хлебом, а вечером, когда уже стемнеет, возвращаются домой к своим детям и старикам.", "Новый мост открыли только в конце года, и к тому времени лавки на другом берегу были закрыты так давно, что никто уже не мог вспомнить, чем в них торговали и кому они принадлежали до большого наводнения.", "Никто не знал."],
    "zh": ["这是一个关于河边小城的故事，讲述了那里的人们多年来的生活。他们每天早上去市场买新鲜的蔬菜和面包，到了晚上天黑以后才和孩子们一起回到家里，坐在院子里说起从前的事情。", "新桥直到年底才开通，那时河对岸的商店已经关门很久了，久到没有人记得里面曾经卖过什么东西，也没有人知道它们从前属于谁，只有几位老人还会在桥头说起那场大水。", "没有人知道。"],
}
LINKS = '<ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul>'
ADS = '<div class="ad-slot">Buy this now, it is the best that you can get in all of the shops of the town.</div>'
TALK = '<div class="comment-list"><p>I have been to the town and I can say that it is not as it was when we were there.</p></div>'


def p(text):
    return [(f"<p>{text}</p>", text)]


def article(body):
    return [("<article>", None), *body, ("</article>", None)]


def wrapped(name, body):
    return [(f"<div {name}>", None), *body, ("</div>", None)]


def around(body):
    return [(f"<header><a href=/>Site</a></header><nav>{LINKS}</nav>", None), *body, (f"{ADS}<footer>All rights</footer>", None)]


def layouts(one, two, short):
    story = [("<h1>Title</h1>", "Title"), *p(one), *p(short), *p(two)]
    plain = [("<h2>Title</h2>", "Title"), (f"<div>{one}</div>", one), (f"<div>{short}</div>", short), (f"<div>{two}</div>", two)]
    return {
        "article": around(article(story)),
        "no article": around(wrapped('class="content"', plain)),
        "layout names": around(wrapped('class="page has-sidebar"', article(story))),
        "a page's id": around(wrapped('id="search-page"', article(story))),
        "comments off": around(wrapped('class="post-comments-off single"', story)),
        "sidebar in a name": around(wrapped('class="content-sidebar-wrap"', story)),
        "comments below": around([*article(story), (TALK, None)]),
        "comments without article": around([*wrapped('class="entry"', story), (TALK, None)]),
        "related articles": around([*article(story), (f'<div class="related"><article><p>{short}</p></article></div>', None)]),
        "link list beside": around([*plain, (f"<div>{LINKS}</div>", None)]),
        "a table of contents": around(article([("<h1>Title</h1>", "Title"), ('<p><a href="#1">First part of it</a> <a href="#2">Second part of it</a></p>', None), *p(one), *p(two)])),
        "role main": around([('<div role="main">', None), *story, ("</div>", None)]),
    }


CASES = [(lang, name) for lang in PROSE for name in layouts(*PROSE["en"])]
#: What stop words alone tell: blocks of words in a row that are no sentences.
JUNK = "Register Login Cart Wishlist Compare Checkout Account Orders Vouchers Stores Careers Press Partners Gifts"


def built(lang, name):
    parts = layouts(*PROSE[lang])[name]
    return "<!DOCTYPE html><html><body>" + "".join(h for h, _ in parts) + "</body></html>", "\n\n".join(t for _, t in parts if t)


@pytest.mark.parametrize(("lang", "name"), CASES)
def test_marked_pages(lang, name):
    page, text = built(lang, name)
    assert pages.main_text(page) == text


def test_junk_words_are_told_by_stop_words():
    one, two, short = PROSE["en"]
    page = f"<body><div>{one}</div><div>{JUNK}</div><div>{short}</div><div>{two}</div></body>"
    assert pages.main_text(page) == "\n\n".join([one, short, two]) or pages.main_text(page) == "\n\n".join([one, two])
    assert JUNK not in pages.main_text(page)


@pytest.mark.parametrize("removed", ["first", "second"])
def test_without_either_pass_pages_are_wrong(monkeypatch, removed):
    if removed == "first":
        monkeypatch.setattr(pages, "first_pass", lambda blocks: [None] * len(blocks))
    else:
        monkeypatch.setattr(pages, "second_pass", lambda blocks, first: [x is True for x in first])
    wrong = sum(pages.main_text(page) != text for page, text in (built(*c) for c in CASES))
    assert wrong >= (len(PROSE) if removed == "first" else len(CASES) // 2)


def test_named_elements():
    long = PROSE["en"][0]
    text = lambda name, more="": pages.main_text(f"<body><div {name}><p>{long}</p></div>{more}</body>")
    for name in ('class="sidebar"', 'id="comments"', 'class="comment-list"', 'class="replies-area"', 'role="navigation"', 'class="cookie"'):
        assert text(name) == "", name
    for name in ('class="no-sidebar"', 'class="with-nav"', 'class="comments-closed"', 'id="newsletter-page"', 'class="sidebar-layout"'):
        assert text(name) == long, name
    assert text('class="promo-box"', f"<div>{long}</div><div>{long}</div>") == f"{long}\n\n{long}"  # not most of the text
