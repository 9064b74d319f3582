"""Scalar building blocks: Column in, Column out, all of Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes and marks taken off a title, in this order. Colon, hyphen and
# backquote in the last one are three marks: as a range they would take off all capitals.
TITLE_PATTERNS = (
    r".*(一|二|三|四|五|六|七|八|九)$",
    r"(第(一|二|三|四|五|六|七|八|九|十|\d)(集|季|部|期))|(season \d+)|(\d+)$",
    r"(预告|电影|大电影|电影大全|系列|视频|电视剧|电视连续剧|电视剧大全|节目|电视节目)$",
    r"(合集|全集|电影合集|电影全集|电视剧全集)$",
    r"(版|中文|中文版|英文|英语|英文版|国语|国语版|2D版|3D版|3d版|2d|2D|3d|3D)$",
    r"(枪版|高清|高清版|DVD版|蓝光|蓝光版)",
    r"(\s)",
    r"[——！，。·～？、~@#￥%……&*（）：；《）《》“”\(\)»〔〕\-「」]\+",
    r"[<> _,()~\';\":\-`!@#$%^&*+=\[\]{}>?/.\|\\\n\r\t]",
)

STRINGS = "array<string>"


def _no_strings() -> Column:
    return F.array().cast(STRINGS)


# ------------------------------------------------------------- splitting tags


def split_tags(text: Column, delimiter: str | None) -> Column:
    """Trimmed, non-empty parts; without a delimiter the text is one tag. Null gives none."""
    parts = F.array(text) if not delimiter else F.split(text, delimiter)
    return F.coalesce(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), _no_strings())


def drop_digit_tags(tags: Column) -> Column:
    return F.filter(tags, lambda x: ~x.rlike(r"^\d+$"))


def lower_trim(text: Column) -> Column:
    return F.lower(F.trim(text))


def replace_tabs(text: Column) -> Column:
    return F.translate(text, "\t", " ")


# ------------------------------------------------------------------ tokenising


def word_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits with two characters or more."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]{2,}"), F.lit(0)), _no_strings())


def phrase_tokens(text: Column, size: int = 2) -> Column:
    """Runs of ``size`` neighbouring word tokens, joined by a blank."""

    def runs(words: Column) -> Column:
        count = F.size(words) - (size - 1)
        joined = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(size))))
        return F.when(count >= 1, joined).otherwise(_no_strings())

    # the words are bound to a variable: a column named inside transform is computed again for each element
    return F.get(F.transform(F.array(word_tokens(text)), runs), F.lit(0))


def bigram_tokens(text: Column) -> Column:
    """Two-character windows of each run of CJK characters."""
    # an empty match ahead of each pair, so pairs overlap and a run is read once
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"(?=([一-鿿]{2}))"), F.lit(1)), _no_strings())


def series_name(title: Column) -> Column:
    """The part before the first ``_`` of a title that ends in ``_<digits>``, else null."""
    name = F.regexp_extract(title, r"^([^_]*)_(?:.*_)?\d+$", 1)
    return F.when(name != "", name)


def title_tokens(title: Column) -> Column:
    """Distinct word tokens and CJK windows of a title, and its series name."""
    tokens = F.array_distinct(F.concat(word_tokens(title), bigram_tokens(title)))
    return F.array_union(tokens, F.filter(F.array(series_name(title)), lambda x: x.isNotNull()))


def clean_title(title: Column, patterns: Sequence[str] = TITLE_PATTERNS) -> Column:
    """The title without season, edition and quality suffixes and marks, or what else ``patterns`` take off in turn."""
    return reduce(lambda text, pattern: F.regexp_replace(text, pattern, ""), patterns, title)


# --------------------------------------------------------------------- numbers


def first_int(text: Column) -> Column:
    return F.regexp_extract(text, r"\d+", 0).try_cast("int")


def suffix_number(text: Column) -> Column:
    """The number after a last ``_``, else 0."""
    return F.coalesce(F.regexp_extract(text, r"_(\d+)$", 1).try_cast("long"), F.lit(0).cast("long"))


def int_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def sigmoid(x: Column, top: float = 1.0, slope: float = 2.3) -> Column:
    return 2 * top / (1 + F.exp(x * -slope)) - 1


def log_weight(x: Column) -> Column:
    return F.log1p(x)


def decay(days: Column, power: float = -0.35) -> Column:
    """min(1, days ** power); 1 for day 0."""
    return F.when(days <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.pow(days.cast("double"), F.lit(power))))


def scaled(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda x: x * factor)


def capped_play(play: Column, duration: Column, times: float = 2.0) -> Column:
    return F.when(play > duration * times, duration * times).otherwise(play)


def play_ratio(play: Column, duration: Column, default: float = 0.2) -> Column:
    return F.when(duration < 1, F.lit(default)).otherwise(F.try_divide(play.cast("double"), duration.cast("double")))


def episode_weight(number: Column, latest: Column, default: float = 0.2) -> Column:
    unknown = (number == 0) | (latest == 0) | (number > latest)
    return F.when(unknown, F.lit(default)).otherwise(F.try_divide(number.cast("double"), latest.cast("double")))


# ----------------------------------------------------------------------- dates


def epoch_seconds(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(pattern)))


def day_string(day: Column, shift: int = 0) -> Column:
    return F.date_format(F.date_add(day, shift), "yyyyMMdd")


def last_days(day: Column, count: int, include_today: bool = False) -> Column:
    """The ``count`` day strings before ``day``, newest first; with today one more."""
    begin = 0 if include_today else 1
    return F.transform(F.sequence(F.lit(begin), F.lit(count)), lambda n: F.date_format(F.date_sub(day, n), "yyyyMMdd"))


# ------------------------------------------------------------- lists and texts


def printed(value: Column, digits: int) -> Column:
    """The double of so many digits that is nearest to ``value`` itself; halves to the even digit.

    Java's ``%.4f`` rounds the shortest decimal that names a double, so 0.00015, which
    lies below that, gives 0.0002 there and 0.0001 in C and SQL. The first 24 bits and
    the rest times a power of ten are exact, so their distance from the half is.
    """
    times = float(10**digits)
    size = F.abs(value)
    high = size.cast("float").cast("double")
    whole = F.floor(size * times).cast("double")
    beyond = (high * times - (whole + 0.5)) + (size - high) * times
    nearest = F.when(beyond > 0, whole + 1).when(beyond < 0, whole).otherwise(whole + whole % 2)
    return F.when((size > 0) & (size < 1e6), F.signum(value) * (nearest / times)).otherwise(value)


def format_weight(weight: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", printed(weight.cast("double"), digits))


def format_list(values: Column, separator: str = ",", mark: str = ":", digits: int = 4) -> Column:
    """``id:weight`` of each struct (id, weight), joined."""
    return F.array_join(F.transform(values, lambda x: F.concat(x["id"].cast("string"), F.lit(mark), format_weight(x["weight"], digits))), separator)


def parse_list(text: Column, separator: str = ";", mark: str = "###") -> Column:
    """Structs (id, weight) of a formatted list; elements without a weight are dropped."""
    parts = F.transform(F.split(text, separator), lambda x: F.split(x, mark))
    return F.transform(F.filter(parts, lambda p: (F.size(p) >= 2) & (p[0] != "")), lambda p: F.struct(p[0].alias("id"), p[1].try_cast("double").alias("weight")))


def parse_tag_mark(text: Column) -> Column:
    """``tag##id`` and ``tag_inner`` to a struct (tag, tag_id, kind)."""
    inner = F.endswith(text, F.lit("_inner"))
    marked = F.split(text, "##")
    return F.struct(
        F.when(inner, F.regexp_replace(text, "_inner$", "")).otherwise(marked[0]).alias("tag"),
        F.when(~inner, F.try_element_at(marked, F.lit(2)).try_cast("long")).alias("tag_id"),
        F.when(inner, F.lit("inner")).when(F.size(marked) > 1, F.lit("curated")).otherwise(F.lit("plain")).alias("kind"),
    )


def zip_tags(names: Column, ids: Column) -> Column:
    """Structs (tag, tag_id) by position; pairs without a name or an id are dropped."""
    pairs = F.zip_with(names, ids, lambda n, i: F.struct(n.alias("tag"), i.try_cast("long").alias("tag_id")))
    return F.filter(pairs, lambda x: x["tag"].isNotNull() & (x["tag"] != "") & x["tag_id"].isNotNull())


def top_of_list(values: Column, count: int) -> Column:
    """The structs (id, weight) of largest weight, ties by id."""

    def compare(a: Column, b: Column) -> Column:
        return F.when(a["weight"] > b["weight"], -1).when(a["weight"] < b["weight"], 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)

    return F.slice(F.array_sort(values, compare), 1, count)


def positional_line(fields: dict[int, Column], width: int, first: str = "-1") -> Column:
    """Fields at their column numbers of a tab-separated line, which opens with ``first``."""
    cells = [F.coalesce(fields[i].cast("string"), F.lit("")) if i in fields else F.lit("") for i in range(1, width)]
    return F.concat_ws("\t", F.lit(first), *cells)


def profile_line(user: Column, categories: Column, tags: Column) -> Column:
    """``guid=<user>``, a tab, and whichever of the two texts exist, joined by ``$``."""
    cats, own = F.concat(F.lit("CAT_S2:"), categories), F.concat(F.lit("TAG:"), tags)
    return F.concat(F.lit("guid="), user.cast("string"), F.lit("\t"), F.concat_ws("$", cats, own))


# ---------------------------------------------------------- decoding and hashes


def decoded_json(payload: Column, field: str) -> Column:
    """A field of the JSON text inside a Base64 payload; null where either is broken."""
    return F.get_json_object(F.try_to_binary(payload, F.lit("base64")).cast("string"), f"$.{field}")


def text_hash(text: Column) -> Column:
    """60 bits of the MD5 of a text as a long, the same in any engine; null for null."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def tag_id_hash(tag: Column) -> Column:
    """Surrogate id of a tag that the dictionary does not have."""
    return text_hash(tag)


def feature_slot(value: Column, slots: int = 1 << 24) -> Column:
    """Slot of the hashing trick."""
    return F.pmod(text_hash(value.cast("string")), F.lit(slots))


def page_url(item: Column, base: str = "https://example.com/page/") -> Column:
    return F.concat(F.lit(base), item.cast("string"), F.lit(".html"))


# ------------------------------------------------------------------ predicates


def is_online(state: Column, item: Column, id_length: int = 11) -> Column:
    return (state == "4") & (F.length(item) == id_length)


def has_state(state: Column, states: tuple[str, ...] = ("0", "4")) -> Column:
    return state.isin(*states)


def is_number(text: Column, kind: str) -> Column:
    return text.try_cast(kind).isNotNull()


def lacks(text: Column, part: str) -> Column:
    """The text does not contain ``part``."""
    return ~F.contains(text, F.lit(part))


def in_set(value: Column, allowed: tuple[str, ...], wildcard: str = "ALL") -> Column:
    return F.lit(True) if wildcard in allowed else value.isin(*allowed)


# Codes of a normal picture scale, title scale and content level.
NORMAL_SCALES = ("1512774", "1512772", "1487112")


def is_normal(picture: Column, title: Column, content: Column, quality: Column, normal: tuple[str, str, str] = NORMAL_SCALES, low: str = "低端") -> Column:
    """Each scale empty or normal, and the quality text not ending in ``low``."""
    plain = [(F.trim(c) == "") | (F.trim(c) == code) for c, code in zip((picture, title, content), normal, strict=True)]
    return plain[0] & plain[1] & plain[2] & ~F.endswith(F.trim(quality), F.lit(low))


# Lifetime classes of an item.
PERMANENT, SHORT, NORMAL = "1335033", "1335035", "1335034"


def is_fresh_class(lifetime: Column, age_days: Column, first_days: Column, second_days: Column, codes: tuple[str, str, str] = (PERMANENT, SHORT, NORMAL)) -> Column:
    """Permanent items stay; short ones a day; normal ones as long as both categories allow."""
    allowed = F.coalesce((age_days <= second_days) & (age_days <= first_days), F.lit(False))
    return F.when(lifetime == codes[0], F.lit(True)).when(lifetime == codes[1], age_days <= 1).when(lifetime == codes[2], allowed).otherwise(F.lit(False))


# Codes of vulgar titles, pictures and content, and the music category.
VULGAR = ("1505275", "1505276", "1487114")
MUSIC = "1494470"


def is_eligible(item: dict[str, Column], vulgar: tuple[str, str, str] = VULGAR, music: str = MUSIC, rejected: str = "已拒绝") -> Column:
    """The item pool's rule on named columns of the catalogue."""
    rules = [
        (item["item"] != "") & (item["first"] != "") & (item["second"] != ""),
        (item["state"] == "4") & (item["drm"] == "0"),
        ~F.contains(item["normalised"], F.lit(rejected)),
        F.contains(item["platforms"], F.lit("3")) & F.contains(item["platforms"], F.lit("5")),
        ~F.contains(item["title_scale"], F.lit(vulgar[0])) & ~F.contains(item["picture_scale"], F.lit(vulgar[1])) & ~F.contains(item["content_level"], F.lit(vulgar[2])),
        (F.length(item["title"]) > 5) & ~item["title"].rlike(r"^\d+$"),
        (item["first"] == music) | ~item["title"].rlike("^[a-zA-Z]+$"),
        F.coalesce(item["duration"].try_cast("int").between(7, 600), F.lit(False)),
    ]
    return reduce(lambda a, b: a & b, rules)


def is_single(text: Column, mark: str = "#") -> Column:
    return (text != "") & ~F.contains(text, F.lit(mark))


def id_kind(tag_id: Column, limit: int = 100_000_000) -> Column:
    return F.when((tag_id > 0) & (tag_id < limit), F.lit("curated")).otherwise(F.lit("derived"))
