"""Small labelled pages: ``data-y`` on an element says content (1) or not (0) for it and all below it up to the next one.

They show layouts that a table of pages may hold none of; their words don't matter, only tags, names and shapes.
"""

_LONG = ("The town council met on Monday evening to talk about the new bridge, which has been planned for several years. "
         "Members agreed that work should begin in spring, before the river rises again.")
_MID = "A short paragraph follows the longer one, with a comma and a full stop."
_REMARK = "I do not agree with this at all, my street has been closed twice and nobody asked us. Thanks for writing about it."
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "sport", "about us", "contact"))
_BODY = f"<h1>New bridge for the old town</h1><p>{_LONG}</p><p>{_MID}</p><h2>Plans</h2><p>{_LONG}</p><ul><li>{_MID}</li><li>{_MID}</li></ul><blockquote><p>{_LONG}</p></blockquote>"
_HEAD = '<html data-y="0"><head><title>New bridge for the old town</title></head><body data-y="0">'
_FOOT = f'<footer data-y="0"><p>Copyright, all rights reserved.</p><ul>{_LINKS}</ul></footer></body></html>'
_FORM = '<form data-y="0"><label>Your e-mail</label><p>Get our letter every week, it is free.</p><select><option>daily</option><option>weekly</option></select><button>Sign up</button></form>'
_COOKIE = '<div class="cookie-notice" data-y="0"><p>We use cookies to make this site better for you. By staying here you agree to this.</p><button>Accept</button></div>'
_SIDE = f'<div class="sidebar widget" data-y="0"><h3>Most read</h3><ul>{_LINKS}</ul><p>Follow us for more stories like this one every day of the week.</p></div>'
_SAID = "".join(f'<div class="comment"><h4>Reader</h4><p>{_REMARK}</p></div>' for _ in range(3))

LABELLED = (
    f'{_HEAD}<header><div class="logo">The Paper</div><nav><ul>{_LINKS}</ul></nav></header><main data-y="1"><article>{_BODY}</article></main><aside data-y="0"><h3>Related</h3><ul>{_LINKS}</ul><p>{_LONG}</p></aside>{_FOOT}',
    f'{_HEAD}<div class="page"><div class="header menu"><ul>{_LINKS}</ul></div><div class="content" data-y="1">{_BODY}</div>{_SIDE}<div class="comments" data-y="0"><h3>Comments</h3>{_SAID}</div></div>{_FOOT}',
    f'{_HEAD}{_COOKIE}<div class="wrapper"><div class="post entry" data-y="1">{_BODY}<div class="share social" data-y="0"><a href="#">Share</a><a href="#">Send</a></div></div>{_FORM}</div>{_FOOT}',
    f'{_HEAD}<div class="navbar menu"><ul>{_LINKS}</ul></div><h1 data-y="1">Bridge</h1><p data-y="1">{_LONG}</p><p data-y="1">{_LONG}</p><div class="ad banner"><p>{_MID}</p></div><p data-y="1">{_MID}</p>{_FOOT}',
    f'{_HEAD}<div class="breadcrumb"><a href="/">Home</a></div><section class="main" data-y="1">{_BODY}<table><tr><td>{_MID}</td><td>12</td></tr></table><div class="ad advert" data-y="0"><p>{_LONG}</p></div><p>{_LONG}</p></section><section class="comments" data-y="0">{_SAID}</section>{_FOOT}',
    f'{_HEAD}<nav><ul>{_LINKS}</ul></nav><div class="ad"><p>{_MID}</p></div><article data-y="1">{_BODY}<aside class="promo" data-y="0"><p>{_LONG}</p></aside><figure><figcaption>{_MID}</figcaption></figure></article><div class="notice banner" role="alert" data-y="0"><p>{_LONG}</p></div><ol class="comment-list" data-y="0"><li class="comment"><p>{_REMARK}</p></li><li class="comment"><p>{_REMARK}</p></li></ol>{_FORM}{_FOOT}',
    f'{_HEAD}<div class="top header">The Paper</div><div data-y="1"><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div><div class="footer" data-y="0"><p>{_MID}</p><p>Imprint</p></div></body></html>',
    f'{_HEAD}<div class="story text" data-y="1"><div>{_LONG}</div><div>{_LONG}</div><pre>a = 1</pre></div><div class="related recommended" data-y="0"><ul>{_LINKS}</ul><div><p>{_LONG}</p></div></div><div class="newsletter subscribe" data-y="0"><p>{_LONG}</p></div><div class="popup modal" data-y="0"><p>{_LONG}</p></div>{_FOOT}',
    f'{_HEAD}<nav><ul>{_LINKS}</ul></nav><article data-y="1">{_BODY}<section class="comments" data-y="0"><h3>Comments</h3>{_SAID}</section></article>{_FOOT}',
    f'{_HEAD}<article data-y="1"><h1>Bridge</h1><div class="notice" data-y="0"><p>{_MID}</p></div><p>{_LONG}</p><ul><li>stone</li><li>steel</li></ul><p>{_MID}</p><div class="newsletter" data-y="0"><p>{_LONG}</p></div></article><div id="disqus_thread" data-y="0"><p>{_REMARK}</p><p>{_REMARK}</p></div>{_FOOT}',
    f'{_HEAD}<main data-y="1"><article>{_BODY}<div class="warning alert" role="alert" data-y="0">{_MID}</div><ol><li>one</li><li>two</li><li>three</li></ol><div id="respond" class="replies" data-y="0"><div><p>{_REMARK}</p></div><div><p>{_REMARK}</p></div></div></article></main>{_FOOT}',
    f'{_HEAD}<article data-y="1"><p>{_LONG}</p><p>{_LONG}</p><ul><li>Work</li><li>Rest</li></ul><dl><dt>Length</dt><dd>90 metres</dd></dl></article><div id="discussion" class="comment-area" data-y="0"><ul><li>{_REMARK}</li><li>{_REMARK}</li></ul></div>{_FOOT}',
)
