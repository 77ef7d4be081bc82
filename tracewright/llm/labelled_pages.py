"""Invented pages whose main text is marked with ``data-main``; they teach the extraction weights."""

from __future__ import annotations

_PROSE = "The river rose in spring and the village moved its market to the hill where the old road ends."


def _p(n: int, tag: str = "p") -> str:
    return "".join(f"<{tag}>{_PROSE} {_PROSE}</{tag}>" for _ in range(n))


def _links(n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(n)) + "</ul>"


_BAR = "<div>" + " ".join(f'<a href="/{x}">{x}</a>' for x in ("Home", "News", "Weather", "About us", "Contact")) + "</div>"
_LINKED = "".join(f"<p>The <a href='/r'>river</a> rose in <a href='/s'>spring</a> and <a href='/v'>the village</a> moved {_PROSE}</p>" for _ in range(4))
_MIXED = f"<h2>Part</h2><p>{_PROSE}</p><h3>Smaller part</h3><p>{_PROSE}</p><h4>Note</h4><ol class='list'><li><strong>First</strong> step</li><li>Second <a href='/z'>step</a></li></ol><pre>{_PROSE}</pre><dl><dt>Term</dt><dd>{_PROSE}</dd></dl><hr><img src='x'><p>Yes.</p>"

_HEAD = "<!DOCTYPE html><html><head><title>A page title here</title><style>p{}</style><script>var a = 1;</script></head><body>"
_FORM = '<form action="/q"><label>Search this site</label><input name="q"><button>Go now</button><select><option>One</option><option>Two</option></select></form>'
_COOKIE = '<div class="cookie-notice consent banner">We use cookies to improve this site. <button>Accept all</button></div>'
_AD = '<div class="ad">Buy two lamps and get one free this week only.</div>'
_ADS = '<div class="advert advertisement sponsored promo">Sponsored: the best kettles of the year.</div>'
_SIDE = '<aside class="sidebar related">Related stories' + _links(5) + "</aside>"
_SIDE_DIV = '<div id="sidebar" class="widget"><h3>Popular posts</h3>' + _links(5) + "</div>"
_COMMENTS = '<section id="comments" class="comments discussion">' + "".join(f'<div class="comment reply"><p>Reader {i} wrote: {_PROSE}</p></div>' for i in range(4)) + "</section>"
_COMMENT_LIST = '<div class="comment-list"><h2>Responses</h2><ol>' + "".join(f'<li class="comment"><article><p>I agree, {_PROSE}</p></article></li>' for i in range(4)) + "</ol></div>"
_NAV = "<nav>" + _links(6) + "</nav>"
_NAV_DIV = '<div class="menu navbar navigation breadcrumb">' + _links(6) + "</div>"
_HEADER = '<header class="site-header masthead"><div class="logo">The Daily Hill</div>' + _NAV + "</header>"
_FOOT = "<footer>&copy; example.org &middot; All pages of the site</footer>"
_FOOT_DIV = '<div id="footer" class="copyright">Copyright of the site. <a href="/t">Terms</a> <a href="/p">Privacy</a></div>'
_SOCIAL = '<div class="share social newsletter subscribe"><a href="#">Share</a> <a href="#">Subscribe to our letter</a></div>'
_NOTICE = '<div class="notice alert popup modal" role="dialog">Please log in to read more of our pages.</div>'
_HIDDEN = '<div hidden class="hidden skip">Skip to the main part</div>'
_ROLES = '<div role="banner">Site name</div><div role="navigation">' + _links(4) + '</div><div role="complementary">See also these pages</div><div role="contentinfo">Contact us</div><div role="search">Find</div>'
_NOSCRIPT = "<noscript>Turn on scripts to see this page.</noscript><iframe>frame text</iframe>"
_END = "</body></html>"

LABELLED_PAGES = [
    _HEAD + _NAV + "<!-- ad -->" + _AD + f"<article data-main><h1>A heading</h1>{_p(6)}</article>" + _FOOT + _END,
    _HEAD + _HEADER + f"<main data-main><article><h1>A heading</h1>{_p(5)}</article></main>" + _SIDE + _COMMENTS + _FOOT + _END,
    _HEAD + _HIDDEN + _NAV_DIV + f'<div id="content" class="post entry" data-main><h2>A heading</h2>{_p(5)}</div>' + _SIDE_DIV + _FOOT_DIV + _END,
    _HEAD + _COOKIE + _HEADER + f'<div class="article-body story text" data-main>{_p(7)}</div>' + _ADS + _COMMENT_LIST + _FOOT + _END,
    _HEAD + _NAV + _FORM + f'<div class="main"><div class="content" data-main><h1>Title</h1>{_p(4)}<blockquote>{_PROSE}</blockquote><ul><li>{_PROSE}</li><li>{_PROSE}</li></ul></div></div>' + _SIDE + _FOOT_DIV + _END,
    _HEAD + _NOTICE + _HEADER + f'<section class="post-content" data-main>{_p(5)}<figure><figcaption>{_PROSE}</figcaption></figure><pre>{_PROSE}</pre></section>' + _SOCIAL + _COMMENTS + _FOOT + _END,
    _HEAD + _ROLES + f'<div role="main" data-main><h1>A heading</h1>{_p(6)}<h2>More</h2>{_p(2)}</div>' + _NOSCRIPT + _END,
    _HEAD + _NAV_DIV + f'<td class="body" data-main>{_p(5, "div")}</td>' + _AD + _SIDE_DIV + _FOOT_DIV + _END,
    _HEAD + _HEADER + f"<article data-main><h1>A heading</h1>{_p(3)}</article>" + _COMMENT_LIST + _FORM + _SOCIAL + _FOOT + _END,
    _HEAD + _NAV + f"<main data-main>{_p(3)}<table><tr><td>{_PROSE}</td><td>{_PROSE}</td></tr></table>{_p(2)}</main>" + _NOTICE + _FOOT + _END,
    _HEAD + _NAV + _AD + f"<article data-main><h1>A heading</h1><p><b>{_PROSE}<br>{_p(1)}<p><i>{_PROSE}</i> <a href='/x'>{_PROSE}</a> <span>{_PROSE}</span> <em>{_PROSE}</em> <strong>{_PROSE}</strong></p></article>" + _FOOT + _END,
    _HEAD + _links(8) + f'<article data-main><h1>A heading</h1>{_p(3)}<ul><li>{_PROSE}</li><li>{_PROSE} <a href="/y">{_PROSE}</a></li></ul><ol><li>{_PROSE}</li></ol></article>' + _FOOT + _END,
    _HEAD + _COOKIE + _NAV + f'<div itemprop="articleBody" data-main>{_p(6)}</div>' + _SIDE + _ADS + _FOOT + _END,
    _HEAD + _HEADER + f"<article data-main><h1>A heading</h1>{_LINKED}{_MIXED}</article>" + _SIDE + _COMMENTS + _FOOT + _END,
    _HEAD + _NAV + f'<div class="page" data-main>{_MIXED}{_LINKED}{_MIXED}<ul><li>One item</li><li>Another short item</li><li>The last one</li></ul></div>' + _SIDE_DIV + _FOOT_DIV + _END,
    _HEAD + _BAR + f"<div data-main><h1>A heading</h1>{_p(3)}<ul><li>One item</li><li>Another short item</li><li>The last one</li></ul>{_LINKED}</div>" + _BAR + _END,
    _HEAD + _BAR + f"<div><div>{_BAR}</div><div data-main>{_LINKED}<ul><li>One item</li><li>Two</li><li>The <a href='/k'>third</a> one here</li></ul></div></div>" + _BAR + _FOOT + _END,
]
