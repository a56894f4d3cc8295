"""Extraction from archived pages with the standard parser, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateloom.functions.keys import HOST

BASE = f"https://{HOST}"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """An element with its attributes, children and text."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children, self.parts = tag, attrs, parent, [], []

    def text(self) -> str:
        return re.sub(r"\s+", " ", " ".join(c.text() if isinstance(c, Node) else c for c in self.parts)).strip()

    def walk(self) -> Iterator["Node"]:
        for child in self.children:
            yield child
            yield from child.walk()

    def has(self, name: str, part: str) -> bool:
        """Whether an attribute holds a text, as in [name*=part]."""
        return part in self.attrs.get(name, "")

    def value(self) -> str:
        """The content attribute, else the text."""
        return _clean(self.attrs.get("content") or self.text())

    def prop(self, name: str) -> list["Node"]:
        return [n for n in self.walk() if name in n.attrs.get("itemprop", "").split()]

    def find(self, tag: str | None = None, **attrs: str) -> list["Node"]:
        def fits(n: Node) -> bool:
            return (tag is None or n.tag == tag) and all(v in n.attrs.get(k.rstrip("_"), "").split() or n.attrs.get(k.rstrip("_")) == v for k, v in attrs.items())

        return [n for n in self.walk() if fits(n)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def _clean(text: str | None) -> str:
    return re.sub(r"\s+", " ", text or "").strip()


def _first(nodes) -> "Node | None":
    return next(iter(nodes), None)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _rows(fn, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(u, *row) for u, h in zip(b["url"], b["html"]) for row in fn(h, u)], columns=["url", *columns])

    return run


def links(pages: DataFrame) -> DataFrame:
    """(url, position, href, text, css_class) of every anchor."""

    def one(html, _):
        for k, a in enumerate((n for n in parse(html).find("a") if n.attrs.get("href")), 1):
            yield k, a.attrs["href"], a.text(), a.attrs.get("class", "")

    return pages.select("url", "html").mapInPandas(_rows(one, ["position", "href", "text", "css_class"]), "url string, position int, href string, text string, css_class string")


def hrefs(html: Column) -> Column:
    """All href values by pattern, with repetitions; stays in the JVM."""
    return F.regexp_extract_all(html, F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))


def max_page(html: Column) -> Column:
    """The greatest page number that a listing links to, 1 without any."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r"[?&](?:amp;)?sp=(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    return F.coalesce(F.array_max(found), F.lit(1))


SPLIT_TRACK = "title string, canonical_url string, artist_names array<string>, artist_profiles array<struct<artist:string,url:string>>, producers array<string>, credits array<struct<artist:string,role:string,source_role:string,url:string>>, album string, label string, release_year string, duration_iso string, duration_ms long, genre string, keywords string, thumbnail_url string, youtube_video_id string"


def _role(text: str) -> str:
    from crateloom.functions.keys import ROLES

    low = text.casefold()
    return ROLES.get(low, low.replace(" ", "_"))


def _milliseconds(iso: str) -> int | None:
    m = re.fullmatch(r"PT(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?", iso)
    if not m or iso == "PT":
        return None
    h, mi, sec = (float(g or 0) for g in m.groups())
    return round((h * 3600 + mi * 60 + sec) * 1000)


def track_page(html: str, base: str) -> tuple:
    """The fields of ``SPLIT_TRACK`` of one page.

    Credits are once per artist, role and source role; a later address fills a missing one. Producers count as credits.
    """
    root = parse(html)
    h1 = _first(root.find("h1"))
    title = ""
    if h1 is not None:
        meta = _first(n for n in h1.prop("name") if n.tag == "meta" and n.attrs.get("content"))
        title = _clean(meta.attrs["content"]) if meta else h1.text()
    link = _first(n for n in root.find("link") if "canonical" in n.attrs.get("rel", "").split())
    artists, profiles = [], []
    for box in root.find(class_="trackArtistNames"):
        for a in box.find("a"):
            href, name = a.attrs.get("href"), a.text()
            if href is None:
                continue
            if name and name not in artists:
                artists.append(name)
            if _artist_link(href) and {"artist": name, "url": urljoin(base, href)} not in profiles:
                profiles.append({"artist": name, "url": urljoin(base, href)})
    credits: dict[tuple, dict] = {}

    def credit(artist: str, role: str, source_role: str, href: str) -> None:
        if artist and role:
            own = credits.setdefault((artist, role, source_role), {"artist": artist, "role": role, "source_role": source_role, "url": ""})
            own["url"] = own["url"] or (urljoin(base, href) if href else "")

    for item in root.find(class_="track-credit-item"):
        head = _first(item.find(class_="track-credit-title"))
        if head is not None:
            source_role = head.text().rstrip(":")
            for who in (n for c in item.prop("contributor") for n in c.prop("name")):
                a = _first(n for n in who.find("a") if n.attrs.get("href"))
                credit(who.text(), _role(source_role), source_role, a.attrs["href"].strip() if a else "")
    producers = []
    for who in (n for p in root.prop("producer") for n in p.prop("name")):
        if who.text() and who.text() not in producers:
            producers.append(who.text())
        a = _first(n for n in who.find("a") if n.attrs.get("href"))
        credit(who.text(), "produced_by", "Producer", a.attrs["href"].strip() if a else "")

    def one(nodes, take=Node.text) -> str:
        node = _first(nodes)
        return "" if node is None else _clean(take(node))

    content = lambda n: n.attrs.get("content", "")
    iso = one(root.prop("duration"), Node.value)
    genres = list(dict.fromkeys(v for n in root.prop("genre") if (v := n.value())))
    words = list(dict.fromkeys(w for n in root.prop("keywords") for x in n.value().split(",") if (w := _clean(x))))
    image = _first(root.prop("thumbnailUrl"))
    sources = [x.split()[0] for x in (image.attrs.get("srcset", "") if image else "").split(",") if x.split()]
    thumb = sources[-1] if sources else _clean(image.attrs.get("src", "")) if image else ""
    video = _first(n for n in root.find(class_="youtube-placeholder") if n.attrs.get("data-id"))
    return (
        title, _clean(link.attrs.get("href", "")) if link else "", artists, profiles, producers, list(credits.values()), one(n for b in root.prop("inAlbum") for n in b.prop("name")), one(root.prop("recordLabel")),
        one(root.prop("datePublished"), content), iso, _milliseconds(iso), ", ".join(genres), ", ".join(words), urljoin(base, thumb) if thumb else "", _clean(video.attrs["data-id"]) if video else "",
    )


def _artist_link(href: str) -> bool:
    from crateloom.functions.pages import NO_ARTIST_LINK

    return href.startswith("/") and href.count("/") == 2 and not any(f"/{w}/" in href.lower() for w in NO_ARTIST_LINK)


def recording(pages: DataFrame, base: str = BASE) -> DataFrame:
    """One row per track page, see ``track_page``; a page without anything gives blank fields."""
    names = [x.split()[0] for x in re.split(r", (?=\w+ )", SPLIT_TRACK)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, *track_page(h, base)) for u, h in zip(b["url"], b["html"])]
            frame = pd.DataFrame(rows, columns=["url", *names])
            frame["duration_ms"] = frame["duration_ms"].astype("Int64")
            yield frame

    return pages.select("url", "html").mapInPandas(run, f"url string, {SPLIT_TRACK}")


def page_artists(pages: DataFrame, base: str = BASE) -> DataFrame:
    """(url, position, kind, artist, role, profile_url): the recording's artists, then those of its credits."""
    parsed = recording(pages, base)
    own = parsed.select("url", F.posexplode("artist_profiles").alias("position", "x")).select("url", (F.col("position") + 1).alias("position"), F.lit("recording").alias("kind"), "x.artist", F.lit("performed_by").alias("role"), F.col("x.url").alias("profile_url"))
    others = parsed.select("url", F.posexplode("credits").alias("position", "x")).select("url", (F.col("position") + 1).alias("position"), F.lit("credit").alias("kind"), "x.artist", "x.role", F.col("x.url").alias("profile_url"))
    return own.union(others)


# ---- relationship pages

def _seconds(text: str | None) -> float | None:
    text = _clean(text)
    m = re.search(r"\b(\d+):(\d{2})\b", text)
    if m:
        return float(int(m[1]) * 60 + int(m[2]))
    m = re.search(r"\b(?:(\d+)\s*m(?:in(?:ute)?s?)?\s*)?(\d+(?:\.\d+)?)\s*s(?:ec(?:ond)?s?)?\b", text, re.I)
    return int(m[1] or 0) * 60 + float(m[2]) if m else None


def _unique(values) -> list[str]:
    return list(dict.fromkeys(v for v in values if v))


def _side(box: Node, base: str, kind: str, timing: float | None) -> dict:
    album = _first(box.prop("inAlbum"))
    of = lambda name: (_first(album.prop(name)) if album else None)
    text = lambda n: None if n is None else n.value() or None
    years = [y for n in ((of("datePublished"), album)) if n is not None for y in re.findall(r"\b(?:19|20)\d{2}\b", n.value())]
    artists: list[str] = []
    for block in box.prop("byArtist"):
        artists += [n.value() for n in block.prop("name")] if block.prop("name") else [a.text() for a in block.find("a")] if not artists else []
    producers = []
    for p in box.prop("producer"):
        named, a = [n.value() for n in p.prop("name")], _first(p.find("a"))
        producers += named or [a.text() if a is not None and a.text() else p.text()]
    url = _first(n for n in box.find("a") if "url" in n.attrs.get("itemprop", "").split() and n.attrs.get("href"))
    length = _first(box.prop("duration"))
    ms = re.match(r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$", length.attrs.get("content", "")) if length is not None else None
    if timing is None and kind == "sampled":
        spots = (n for n in box.walk() if any(n.has(k, w) for k in ("class", "id") for w in ("sample-dest-timing", "sample-source-timing")) or any(n.has("class", w) for w in ("sampleTiming", "sample-timing")))
        timing = next((t for n in spots if (t := _seconds(n.text())) is not None), None)
    return {
        "name": text(_first(box.prop("name"))), "artists": _unique(artists), "year": int(years[0]) if years else None, "album": text(of("name")), "label": text(of("recordLabel")),
        "url": page_url(url.attrs["href"], base) if url else None, "producers": _unique(producers), "sample_timestamp_seconds": timing,
        "duration": int(ms[1] or 0) * 3600 + int(ms[2] or 0) * 60 + float(ms[3] or 0) if ms else None,
    }


def page_url(href: str, base: str) -> str:
    """Absolute, without query, single slashes, one end slash."""
    path = re.sub(r"/+", "/", urlparse(urljoin(base, _clean(unquote(href)))).path)
    return base.rstrip("/") + (path if path.endswith("/") else path + "/")


TRACK = "struct<name:string,artists:array<string>,year:int,album:string,label:string,url:string,producers:array<string>,sample_timestamp_seconds:double,duration:double>"
KINDS = {"sample": "sampled", "cover": "covers", "remix": "remix", "interpolation": "interpolates"}


def relationship_page(html: str, url: str, base: str) -> tuple:
    root, path = parse(html), urlparse(url or "").path.lower()
    kind = next((v for k, v in KINDS.items() if f"/{k}/" in path), None)
    text = root.text()
    if kind is None:
        low = text.lower()
        kind = next((v for w, v in (("remix", "remix"), ("cover", "covers"), ("interpolates", "interpolates"), ("interpolated", "interpolates"), ("interpolation", "interpolates"), ("sample", "sampled")) if w in low), None)
    boxes = [_first(n for n in root.walk() if n.attrs.get("id") == f"sampleWrap_{x}") for x in ("dest", "source")]
    missing = [x for x, b in zip(("destination", "source"), boxes) if b is None]
    if missing:
        return kind, None, None, None, None, f"no {missing[0]} container"
    timing = []
    for side in ("dest", "source"):
        spots = [n for k in ("class", "id") for n in root.walk() if n.has(k, f"sample-{side}-timing")]
        tried = (_seconds(x) for n in spots for x in (*(n.attrs.get(f"data-{k}") for k in ("time", "timestamp", "seconds")), n.attrs.get("content"), n.text()))
        timing.append(next((t for t in tried if t is not None), None))
    number = re.search(r"/(?:sample|cover|remix|interpolation)/(\d+)/", page_url(url, base)) if url else None
    typed = [n for k in ("sampleType", "relationshipType") for n in root.prop(k)] + [n for n in root.walk() if any(n.has("class", w) for w in ("sample-type", "sampleType"))]
    told = next((v for n in typed if (v := n.value())), None)
    if told is None:
        m = next((m for p in (r"Direct Sample of[^<\n]*", r"Cover Version", r"Remix", r"Interpolat(?:es|ed|ion)[^<\n]*") if (m := re.search(p, text, re.I))), None)
        told = _clean(m[0]) if m else {"covers": "Cover Version", "remix": "Remix"}.get(kind)
    return kind, int(number[1]) if number else None, *(_side(b, base, kind, t) for b, t in zip(boxes, timing)), told, None


def relationship_details(pages: DataFrame, base: str = BASE) -> DataFrame:
    """Both tracks of each relationship page, its type, number and sample type; ``error`` names a missing container."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, *relationship_page(h, u, base)) for u, h in zip(b["url"], b["html"])]
            frame = pd.DataFrame(rows, columns=["url", "relationship_type", "number", "track_1", "track_2", "sample_type", "error"])
            frame["number"] = frame["number"].astype("Int64")
            yield frame

    return pages.select("url", "html").mapInPandas(run, f"url string, relationship_type string, number long, track_1 {TRACK}, track_2 {TRACK}, sample_type string, error string")


def secondary_pages(pages: DataFrame, base: str = BASE) -> DataFrame:
    """(url, section, page_url, link_text): the lists that a track page's sections lead to, once each."""
    words = ("/sampled/", "/samples/", "/covered/", "/covers/", "/interpolat", "/remix")

    def one(html, _):
        seen = set()
        for head in parse(html).find("h3", class_="section-header-title"):
            box = head
            for _ in range(5):
                box = box.parent
                if box is None or any(n.attrs.get("href") for n in box.find("a")):
                    break
            for a in box.find("a") if box is not None else []:
                href = a.attrs.get("href", "").strip()
                if "href" in a.attrs and (any(w in href for w in words) or a.text().casefold() == "see all"):
                    key = (head.text(), urljoin(base, href))
                    if key not in seen:
                        seen.add(key)
                        yield (*key, a.text())

    return pages.select("url", "html").mapInPandas(_rows(one, ["section", "page_url", "link_text"]), "url string, section string, page_url string, link_text string")


def relationship_links(html: Column, base: str = BASE) -> Column:
    """Distinct absolute addresses of numbered relationships in a page, in the JVM."""
    found = F.filter(hrefs(html), lambda h: h.rlike(r"/(sample|cover|remix|interpolation)/\d+"))
    absolute = F.transform(found, lambda h: F.when(h.rlike("^https?://"), h).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(h, "^/+", ""))))
    return F.array_distinct(F.transform(absolute, lambda h: F.concat(F.regexp_replace(F.regexp_replace(h, r"[?#].*$", ""), "/+$", ""), F.lit("/"))))


def first_relationship(html: Column) -> Column:
    """The first numbered relationship of a page by type: sample, cover, remix, interpolation; null without one."""
    of = lambda word: F.try_element_at(F.filter(hrefs(html), lambda h: h.rlike(rf"/{word}/\d+")), F.lit(1))
    return F.coalesce(*map(of, ("sample", "cover", "remix", "interpolation")))


def media(html: Column) -> Column:
    """struct(image_url, video_url) of an archived page: the social image, else the first image; the first video link or id."""
    take = lambda p: F.nullif(F.regexp_extract(html, p, 1), F.lit(""))
    image = F.coalesce(take(r"(?i)<meta[^>]+property=[\"']og:image[\"'][^>]+content=[\"']([^\"']+)"), take(r"(?i)<meta[^>]+content=[\"']([^\"']+)[\"'][^>]+property=[\"']og:image"), take(r"(?i)<img[^>]+src=[\"']([^\"']+)"), F.lit(""))
    link = take(r"(?i)href=[\"'](https?://(?:www\.)?(?:youtube\.com|youtu\.be|youtube-nocookie\.com)/[^\"']+)")
    ident = F.coalesce(*[take(p) for p in (r"(?i)youtube(?:-nocookie)?\.com/embed/([\w-]{11})", r"(?i)youtube\.com/watch\?v=([\w-]{11})", r"(?i)data-(?:youtube-)?id=[\"']([\w-]{11})[\"']")])
    return F.struct(image.alias("image_url"), F.coalesce(link, F.concat(F.lit("https://www.youtube.com/watch?v="), ident), F.lit("")).alias("video_url"))


def artwork(html: Column) -> Column:
    """Distinct image addresses of a page, social image first."""
    social = F.regexp_extract_all(html, F.lit(r"(?i)og:image[\"'][^>]+content=[\"']([^\"']+)"), F.lit(1))
    return F.array_distinct(F.concat(social, F.regexp_extract_all(html, F.lit(r"(?i)<img[^>]+src=[\"']([^\"']+)"), F.lit(1))))


def artist_aliases(pages: DataFrame) -> DataFrame:
    """(url, alias) of profile pages, in order and once, ignoring case."""
    return profile(pages).select("url", F.posexplode("aliases").alias("position", "alias")).select("url", (F.col("position") + 1).alias("position"), "alias")


def track_links(pages: DataFrame) -> DataFrame:
    """(page, href, title): track addresses of pages with their longest link text."""
    from crateloom.functions.pages import is_idle_label, is_track_page
    from crateloom.operators.frames import longest_wins

    found = links(pages).where(is_track_page(F.col("href")) & ~is_idle_label(F.col("text")))
    return longest_wins(found.select("url", F.regexp_replace("href", r"[?#].*$", "").alias("href"), "text"), ["url", "href"], "text")


def data_uri(content: Column, mime: Column) -> Column:
    return F.when(F.length(content) > 0, F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content))).otherwise("")


def structure(pages: DataFrame, ids: tuple[str, ...] = ("sampleWrap_dest", "sampleWrap_source")) -> DataFrame:
    """(url, position, depth, tag, attributes) of all elements inside the named containers."""

    def one(html, _):
        k = 0
        for box in (n for n in parse(html).walk() if n.attrs.get("id") in ids):
            stack = [(0, box)]
            while stack:
                depth, node = stack.pop()
                k += 1
                yield k, depth, node.tag, " ".join(f"{a}={v}" for a, v in sorted(node.attrs.items()))
                stack += [(depth + 1, n) for n in reversed(node.children)]

    return pages.select("url", "html").mapInPandas(_rows(one, ["position", "depth", "tag", "attributes"]), "url string, position int, depth int, tag string, attributes string")


def relationships(pages: DataFrame, artist_pick: str = "first") -> DataFrame:
    """One row per related track of a page's tables; the first (or last) artist link counts, the last of equal rows wins."""
    names = ["relationship_type", "related_track", "related_artist", "year", "relationship_url", "detail"]

    def one(html, _):
        found = {}
        for tr in parse(html).find("tr"):
            anchors = [(a.attrs.get("href", ""), a.text()) for a in tr.find("a")]
            link = next(((h, t) for h, t in anchors if re.search(r"/(sample|cover|remix|interpolation)s?/\d+|/(sampled|covered|remixed|interpolated)/", h)), None)
            if link is None:
                continue
            kind = next((v for k, v in {"sample": "sampled", "cover": "covered", "interpol": "interpolated", "remix": "remixed"}.items() if k in link[0]), "")
            fits = [t for h, t in anchors if t and re.fullmatch(r"(?:https?://[^/]+)?/[^/]+/", h)]
            artist = (fits[0] if artist_pick == "first" else fits[-1]) if fits else ""
            cells = [td.text() for td in tr.find("td")]
            year = next((c for c in cells if re.fullmatch(r"\d{4}", c) and 1800 <= int(c) <= 2100), "")
            taken = {link[1], artist, year, ""}
            detail = next((c for c in cells if c not in taken and not c.startswith("See ") and link[1] not in c), "")
            found[kind, link[1], artist, link[0]] = (kind, link[1], artist, year, link[0], detail)
        yield from found.values()

    return pages.select("url", "html").mapInPandas(_rows(one, names), "url string, " + ", ".join(f"{n} string" for n in names))


def listing(pages: DataFrame) -> DataFrame:
    """Tracks of a listing page: links of exactly two segments inside items, once each."""

    def one(html, _):
        seen = {}
        for item in parse(html).find(class_="trackItem"):
            for a in item.find("a"):
                path = re.sub(r"^https?://[^/]+|[?#].*$", "", a.attrs.get("href", ""))
                if len([p for p in path.split("/") if p]) == 2 and a.text():
                    seen.setdefault(path.casefold(), (path, a.text()))
                    break
        yield from ((k, *v) for k, v in enumerate(seen.values(), 1))

    return pages.select("url", "html").mapInPandas(_rows(one, ["position", "href", "title"]), "url string, position int, href string, title string")


def profile(pages: DataFrame) -> DataFrame:
    """Name, aliases, groups and members of an artist page, by its labelled lines."""
    labels = {"aliases": r"^(aliases?|also known as)\b", "groups": r"^(groups?|member of)\b", "members": r"^(members?|current members?)\b", "country": r"^(country|from)\b"}

    def one(html, _):
        root = parse(html)
        name = next((n.text() for n in root.find("h1")), "")
        got = {k: "" for k in labels}
        for node in root.walk():
            m = re.match(r"^([\w ]{3,20}):\s*(.+)$", node.text()) if node.tag in ("p", "li", "div", "dd", "tr") and len(node.text()) < 400 else None
            if m:
                for k, pattern in labels.items():
                    if re.match(pattern, m[1].strip(), re.I) and not got[k]:
                        got[k] = m[2].strip()
        yield name, *([v.strip() for v in re.split(r"[,;|]|\s/\s", got[k]) if v.strip()] for k in ("aliases", "groups", "members")), got["country"]

    names = ["name", "aliases", "groups", "members", "country"]
    schema = "url string, name string, aliases array<string>, groups array<string>, members array<string>, country string"
    return pages.select("url", "html").mapInPandas(_rows(one, names), schema)
