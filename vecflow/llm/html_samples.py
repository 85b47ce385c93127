"""Labelled pages to learn from: drawn layouts whose every block is known to be main text or not.

A page is a main part (an article, a main element or a plainly named division, in wrappers or without) among parts of
the kinds of KINDS, each in one of its elements, with names made of its own words and of words that tell nothing, or
without a name. Parts come in any order that pages use, in the main part too, and may be left out. Texts are made of
drawn syllables, so that nothing can be learned from their vocabulary but what parts really say (LABELS); sentences
like an article's stand in every part. Each block starts with a mark that tells its label.
"""

from __future__ import annotations

import random

MAIN, OTHER = "\ue000", "\ue001"

# What the parts of pages are called, and what they say.
KINDS: dict[str, tuple[str, str, str]] = {
    # kind: elements, words of their names, roles
    "menu": ("nav nav nav ul div div header section", "menu nav navbar navigation navi topnav mainnav breadcrumb breadcrumbs links tabs pagination pager paging skip language languages toc index", "navigation menubar menu"),
    "header": ("header header div div section", "header masthead top topbar head logo branding brand sitename tagline search hero", "banner"),
    "footer": ("footer footer footer div div section", "footer foot bottom copyright colophon legal imprint credits siteinfo contact", "contentinfo"),
    "sidebar": ("aside aside aside div div section ul", "sidebar side aside widget widgets related recommended recommendations popular trending latest tags tagcloud rail secondary archive archives categories teaser teasers more similar", "complementary"),
    "notice": ("div div section dialog p aside div", "cookie cookies consent notice notices gdpr privacy alert modal popup overlay paywall message warning toast announcement disclaimer banner info hint", "alert dialog alertdialog status"),
    "advert": ("div div aside ins section p figure span", "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion adsense commercial dfp partner partners affiliate banner werbung anzeige adsbygoogle taboola outbrain doubleclick slot", ""),
    "form": ("form form form div fieldset", "form newsletter search signup signin login subscribe subscription contact register poll survey", "form search"),
    "comments": ("section section div div ol ul", "comment comments response responses reply replies discussion disqus feedback thread respond commentlist reviews review guestbook reader readers opinions", ""),
    "share": ("div ul div section", "share shares sharing social follow toolbar tools print bookmark like addthis buttons", "toolbar"),
    "hidden": ("div p section span", "hidden sr screenreader offscreen noscript", ""),
}
MAIN_TAGS = "article article article article main main div div div section section td"
MAIN_NAMES = "article content content post entry main story body text page story articlebody postcontent entrycontent maincontent single hentry blog prose copy news detail"
NEUTRAL = "site wrapper wrap container inner outer row col column box block left right center section module region area item group clearfix page layout grid flex element default large small primary first last even odd desktop mobile fluid panel card list view unit component"
LABELS = {
    "menu": "Home|About|Contact|News|Menu|Login|Start|Startseite|Accueil|Inicio|Über uns|Kontakt|Products|Blog|Archive|Next|Previous|Skip to content|Impressum|Contacto",
    "header": "Welcome to|The site of|Search|Login|Menu|Home|Suche|Recherche",
    "footer": "© 2021|© 2024|Copyright|All rights reserved|Impressum|Datenschutz|Privacy policy|Terms of use|Mentions légales|Aviso legal|Contact|Powered by",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|Categories|Tags|Archives|See also|Mehr zum Thema|À lire aussi|Lo más leído|Follow us",
    "notice": "We use cookies|This site uses cookies. Accept|Cookies akzeptieren|Nous utilisons des cookies|Utilizamos cookies|Accept all|Please subscribe|Notice:|Warning:|Your browser is out of date",
    "advert": "Advertisement|Sponsored|Anzeige|Werbung|Publicité|Publicidad|Buy now|Special offer|Ad",
    "form": "Name|Email|E-mail address|Message|Subscribe|Send|Search|Submit|Sign up for our newsletter|Password|Anmelden|Envoyer|Enviar",
    "comments": "Comments|Leave a reply|Reply|3 comments|says:|Kommentare|Commentaires|Comentarios|Antworten|Répondre|posted on|Like|Report|Great post!",
    "share": "Share|Tweet|Print|Facebook|Email|Teilen|Partager|Compartir|Like|Copy link",
    "hidden": "Skip|Loading|Please enable JavaScript|Menu",
}
_SYLLABLES = "ba be bi bo bu da de di do du fa fe fi ga ge go ha he hi ja jo ka ke ki ko la le li lo lu ma me mi mo mu na ne ni no nu pa pe pi po ra re ri ro ru sa se si so su ta te ti to tu va ve vi wa we ya yo za zo an en in on un ar er ir or ur as es is os at et it ot ent ion ing und ich ung eur eau ció ñe ß é ä ü".split()
SEPARATORS = ("-", "_", "__", "--", "")


class Sampler:
    """Draws pages. Equal seeds give equal pages."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.vocabulary = ["".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) for _ in range(5000)]

    def word(self) -> str:
        return self.r.choice(self.vocabulary)

    def words(self, n: int) -> str:
        return " ".join(self.r.choices(self.vocabulary, k=n))

    def sentence(self) -> str:
        n = self.r.randint(1, 3) if self.r.random() < 0.08 else self.r.randint(3, 12)
        w = self.r.choices(self.vocabulary, k=n)
        if n > 7 and self.r.random() < 0.5:
            w[n // 2] += ","
        return " ".join(w).capitalize() + self.r.choice(("...." if self.r.random() < 0.05 else ".", ".", ".", "?", "!"))

    def prose(self, most: int = 8) -> str:
        if self.r.random() < 0.08:
            return self.word().capitalize() + "." if self.r.random() < 0.7 else self.words(self.r.randint(3, 300))
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def name(self, words: str, sure: float = 0.5) -> str:
        """A class value of some of the words (with probability ``sure`` only them), with words that tell nothing."""
        r = self.r
        own = [r.choice(words.split())]
        if r.random() < 0.2:
            own.append(r.choice(words.split()))
        if r.random() > sure:
            own.insert(r.randint(0, len(own)), r.choice(NEUTRAL.split()) if r.random() < 0.8 else self.word())
        sep = r.choice(SEPARATORS)
        text = sep.join(own) if sep else own[0] + "".join(x.capitalize() for x in own[1:])
        if r.random() < 0.15:
            text += f"-{r.randint(1, 40)}"
        return text.replace("-", " ") if r.random() < 0.15 else text

    def tag(self, tag: str, words: str, roles: str = "", named: float = 0.85) -> tuple[str, str]:
        """(start tag, end tag)."""
        r, attrs = self.r, ""
        if r.random() < named:
            attrs += f' {r.choice(("class", "class", "class", "id"))}="{self.name(words)}"'
        if roles and r.random() < 0.15:
            attrs += f' role="{r.choice(roles.split())}"'
        if r.random() < 0.1:
            attrs += f' data-{self.word()}="{r.randint(0, 99)}"'
        return f"<{tag}{attrs}>", f"</{tag}>"

    def inline(self, text: str, links: float = 0.1) -> str:
        """The text with some of its words in inline elements."""
        r, w = self.r, text.split(" ")
        for i in r.sample(range(len(w)), r.randint(0, 1 + len(w) // 25)):
            t = r.choice(("b", "i", "em", "strong", "span", "code", 'span class="x"'))
            w[i] = f"<{t}>{w[i]}</{t.split()[0]}>"
        for i in r.sample(range(len(w)), r.randint(0, int(len(w) * 0.3 * links + r.random()))):
            w[i] = f'<a href="/{r.randint(0, 999)}">{w[i]}</a>'
        if r.random() < 0.05:
            w.insert(len(w) // 2, "<br>")
        return " ".join(w)

    def block(self, tag: str, text: str, label: str, link: bool = False) -> str:
        text = f"{label}{text}"
        if link:
            text = f'<a href="/{self.r.randint(0, 9999)}">{text}</a>'
        close = "" if tag in ("p", "li", "td", "dd") and self.r.random() < 0.15 else f"</{tag}>"
        return f"<{tag}>{text}{close}" + self.r.choice(("", "", "\n", "  "))

    def part(self, kind: str) -> str:
        """A part that is not main text."""
        r, (tags, words, roles) = self.r, KINDS[kind]
        tag = r.choice(tags.split())
        plain = tag in ("div", "section", "ul", "ol", "p", "span", "figure")
        start, end = self.tag(tag, words, roles, 1.0 if plain else 0.5)
        said = LABELS[kind].split("|")
        say = lambda: r.choice(said) if r.random() < 0.6 else self.words(r.randint(1, 4))
        if kind == "hidden":
            start = f"<{tag} " + r.choice(('style="display:none"', "hidden", 'aria-hidden="true"', 'style="display: none;"', f'class="{self.name(words)}"')) + ">"
        if tag in ("p", "span", "ins"):
            return f"{start}{OTHER}{self.prose(2) if r.random() < 0.6 else say()}{end}"
        out = []
        inner = "".join(self.tag("div", NEUTRAL)[0] for _ in range(r.choice((0, 0, 0, 1, 2))))
        if r.random() < (0.7 if kind == "header" else 0.3):
            out.append(self.block(r.choice(("h1", "h2", "h2", "p", "div") if kind == "header" else ("h2", "h3", "h4", "p", "div")), say() if r.random() < 0.7 else self.sentence(), OTHER))
        if tag in ("ul", "ol"):
            out += [self.block("li", say() if r.random() < 0.7 else self.prose(2), OTHER, r.random() < 0.7) for _ in range(r.randint(1, 6))]
        elif kind == "form":
            for _ in range(r.randint(1, 5)):
                out.append(r.choice((
                    f"<label>{OTHER}{say()}</label><input type=text name=q><br>", f"<p>{OTHER}{say()} <input type='email' value=\"x\"></p>", f"<button type=submit>{OTHER}{say()}</button>",
                    f"<select><option>{OTHER}{say()}<option>{OTHER}{say()}</select>", f"<textarea>{OTHER}{say()}</textarea>", f"<p>{OTHER}{self.prose(2)}</p>", f"<div>{OTHER}{say()}</div>",
                )))
        elif kind == "comments":
            for _ in range(r.randint(1, 4)):
                start_, end_ = self.tag(r.choice(("div", "li", "article", "div")), r.choice((words, NEUTRAL)), "", 0.7)
                head = self.block(r.choice(("h4", "div", "cite", "p")), f"{self.word().capitalize()} {r.choice(said)}", OTHER) if r.random() < 0.6 else ""
                out.append(start_ + (head if "<cite>" not in head else f"<div>{head}</div>") + "".join(self.block("p", self.inline(self.prose(4)), OTHER) for _ in range(r.randint(1, 3))) + end_)
        else:
            way = r.random()
            if way < 0.4 or kind == "menu" and way < 0.8:
                items = "".join(self.block("li", say() if r.random() < 0.6 else self.words(r.randint(1, 6)), OTHER, r.random() < 0.85) for _ in range(r.randint(1, 6)))
                out.append(f"<ul>{items}</ul>")
            elif way < 0.75:
                out += [self.block(r.choice(("p", "p", "div", "h3")), self.inline(self.prose(3) if r.random() < 0.7 else say(), 0.5), OTHER) for _ in range(r.randint(1, 4))]
            elif way < 0.9:
                out.append(f"{OTHER}{self.inline(self.prose(2) if r.random() < 0.6 else say(), 0.5)}")
            else:
                out.append(" | ".join(f'<a href="#">{OTHER if i == 0 else ""}{say()}</a>' for i in range(r.randint(2, 6))))
        return start + inner + "".join(out) + "</div>" * inner.count("<div") + end

    def article(self) -> str:
        """Blocks of main text, among which parts of other kinds may stand."""
        r, out = self.r, []
        if r.random() < 0.75:
            head = self.block(r.choice(("h1", "h1", "h1", "h2")), self.words(r.randint(2, 10)).capitalize(), MAIN)
            out.append(f"<header>{head}</header>" if r.random() < 0.1 else head)
        long = r.random() < 0.06
        for _ in range(r.choice((1, 1, 2, 3, 4, 5, 6, 8, 10, 14, 20)) * (6 if long else 1)):
            way = r.random()
            if way < 0.74:
                out.append(self.block("p", self.inline(self.prose(r.choice((1, 3, 8)))), MAIN))
            elif way < 0.79:
                out.append(self.block(r.choice(("h2", "h3", "h4")), self.words(r.randint(1, 8)).capitalize(), MAIN))
            elif way < 0.84:
                t = r.choice(("ul", "ol"))
                out.append(f"<{t}>" + "".join(self.block("li", self.inline(self.prose(2) if r.random() < 0.5 else self.words(r.randint(1, 6)), 0.4), MAIN) for _ in range(r.randint(1, 6))) + f"</{t}>")
            elif way < 0.87:
                out.append(f"<blockquote>{self.block('p', self.prose(3), MAIN) if r.random() < 0.6 else MAIN + self.prose(2)}</blockquote>")
            elif way < 0.89:
                out.append("<table>" + "".join("<tr>" + "".join(self.block("td", self.words(r.randint(1, 3)), MAIN) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif way < 0.91:
                out.append(self.block("pre", self.words(12), MAIN))
            elif way < 0.93:
                out.append(f'<figure><img src="a.png" alt="x">{self.block("figcaption", self.prose(1), MAIN)}</figure>')
            elif way < 0.95:
                out.append(f"<b>{MAIN}{self.prose(2)}<br>" if r.random() < 0.5 else f"{MAIN}{self.prose(2)}<hr>")
            elif way < 0.97:
                out.append(self.block("div", self.prose(3), MAIN))
            elif way < 0.98:
                start, end = self.tag(r.choice(("section", "div")), NEUTRAL + " chapter intro lead summary paragraph", "", 0.6)
                out.append(start + "".join(self.block("p", self.inline(self.prose(5)), MAIN) for _ in range(r.randint(1, 3))) + end)
            else:
                out.append("<script>var t=\"</p>\";</script><style>p{margin:0}</style><!-- x -->")
        if r.random() < 0.05:  # one line over and over
            line = self.sentence() if r.random() < 0.7 else " ".join([self.word().capitalize()] * r.randint(1, 60))
            t = r.choice(("p", "p", "div", "li"))
            out += [f"<{t}>{MAIN}{line}</{t}>"] * r.randint(3, 120)
        while r.random() < 0.55:
            out.insert(r.randint(0, len(out)), "\n" + self.part(r.choice(("advert", "advert", "sidebar", "share", "form", "notice", "comments", "menu", "hidden"))))
        if r.random() < 0.12:
            out.append(self.part("comments"))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        if r.random() < 0.05:  # a main part and nothing else
            start, end = self.tag(r.choice(("article", "article", "main")), MAIN_NAMES, "", 0.3)
            return start + "".join(self.block("p", self.prose(6) if r.random() < 0.5 else self.words(r.randint(3, 400)), MAIN) for _ in range(r.randint(1, 3))) + end
        tag = r.choice(MAIN_TAGS.split())
        start, end = self.tag(tag, MAIN_NAMES, "main", 0.4 if tag in ("article", "main") else 1.0)
        main = start + self.article() + end
        if tag == "td":
            main = f"<table><tr>{main}</tr></table>"
        for _ in range(r.choice((0, 0, 1, 1, 2))):
            start, end = self.tag(r.choice(("div", "div", "main", "section")), NEUTRAL + " content main page", "main", 0.8)
            near = self.part(r.choice(list(KINDS))) if r.random() < 0.3 else ""
            main = start + (near + main if r.random() < 0.5 else main + near) + end
        before = [self.part(k) for k in ("hidden", "notice", "header", "menu", "advert", "form", "share") if r.random() < (0.7 if k == "header" else 0.45)]
        after = [self.part(k) for k in ("share", "sidebar", "comments", "form", "advert", "menu", "notice", "footer") if r.random() < 0.4]
        if r.random() < 0.3:
            r.shuffle(before)
        if r.random() < 0.2:
            r.shuffle(after)
        if r.random() < 0.15:
            before.append(self.part("sidebar"))
        head = f"<title>{OTHER}{self.words(r.randint(1, 8))}</title>" if r.random() < 0.9 else ""
        body = f'<body class="{self.name(NEUTRAL + " home single sidebar content post menu", 0.3)}">' if r.random() < 0.3 else "<body>"
        whole = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8">{head}<style>p{{margin:0}}</style><script>var t="</p>";</script></head>{body}' + "".join(before) + main + "".join(after)
        return whole + ("</body></html>" if r.random() < 0.9 else "")
