"""Word lists and rules that drive caption expansion.

A ``Lexicon`` is plain data: pass another one for another language or domain.
All of it is compiled into literals of built-in expressions when a plan is
built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass


def word_pattern(words: Iterable[str]) -> str:
    """Alternation that prefers earlier words, grouped by first character.

    Words with different first characters cannot compete, so moving the common
    ones into a character class changes no match.  It spares the regex engine
    from trying every word at every position.
    """
    tails: dict[str, list[str]] = {}
    for word in words:
        tails.setdefault(word[0], []).append(word[1:])
    heads: dict[tuple[str, ...], list[str]] = {}
    for head, rest in tails.items():
        heads.setdefault(tuple(rest), []).append(head)
    branches = []
    for rest, firsts in heads.items():
        escaped = [re.escape(t) for t in rest]
        tail = escaped[0] if len(escaped) == 1 else f"(?:{'|'.join(escaped)})"
        head = f"[{''.join(firsts)}]" if len(firsts) > 1 else re.escape(firsts[0])
        branches.append(head + tail)
    return f"(?:{'|'.join(branches)})"


@dataclass(frozen=True)
class AttributeRule:
    """Find ``lead colour 的? filler object`` and say ``verb colour object``."""

    role: str
    verb: str
    objects: tuple[str, ...]
    lead: str = ""
    filler: str = ""
    colour_optional: bool = False

    @property
    def shape(self) -> tuple[str, str, bool]:
        return self.lead, self.filler, self.colour_optional


@dataclass(frozen=True)
class Family:
    """Phrases that contain ``needs`` and one of ``words``, or equal one."""

    name: str
    words: tuple[str, ...]
    needs: str = ""
    whole: bool = False


@dataclass(frozen=True)
class Lexicon:
    # separators and trimming
    comma: str
    full_stop: str
    caption_trim: str
    query_trim: str
    separator_merges: tuple[tuple[str, str], ...]
    separator_runs: str
    particle: str
    # wordings
    wordings: tuple[tuple[str, str], ...]
    query_wordings: tuple[tuple[str, str], ...]
    min_query_len: int
    short_caption_len: int
    # colour-object attributes
    colours: tuple[str, ...]
    short_colours: tuple[tuple[str, str], ...]
    roles: tuple[str, ...]
    rules: tuple[AttributeRule, ...]
    actions: tuple[tuple[str, tuple[str, ...]], ...]
    action_role: str
    rider_role: str
    shield_role: str
    families: tuple[Family, ...]
    family_pairs: tuple[tuple[str, str], ...]
    # subjects and noise
    subjects: tuple[str, ...]
    default_subject: str
    subject_aliases: tuple[tuple[str, str], ...]
    noise_openers: tuple[str, ...]
    noise_words: tuple[str, ...]
    clause_rest: str
    secondary_clauses: tuple[str, ...]
    secondary_cues: tuple[str, ...]
    # caption variants
    compressions: tuple[tuple[str, str], ...]
    person_terms: tuple[str, ...]
    visual_terms: tuple[str, ...]
    actor_terms: tuple[str, ...]
    background_terms: tuple[str, ...]
    clause_split: str
    subject_split: str
    subject_cues: str
    # review
    review_keywords: tuple[str, ...]

    @property
    def colour_pattern(self) -> str:
        return word_pattern((*self.colours, *(short for short, _ in self.short_colours)))

    def pattern(self, shape: tuple[str, str, bool], objects: Iterable[str]) -> str:
        lead, filler, optional = shape
        colour = f"({self.colour_pattern})" + ("?" if optional else "")
        return f"{lead}{colour}{self.particle}?{filler}({word_pattern(objects)})"

    def rule_pattern(self, rule: AttributeRule) -> str:
        return self.pattern(rule.shape, rule.objects)

    def scans(self) -> list[list[AttributeRule]]:
        """Rules grouped so that one regex scan serves a whole group.

        Rules of one shape can share a scan when their matches cannot overlap
        (no colour starts with a character found later in a match) and a
        match's object tells its rule (none starts or ends another rule's).
        """
        colours = (*self.colours, *(short for short, _ in self.short_colours))
        heads = {c[0] for c in colours}
        groups: dict[tuple[str, str, bool], list[AttributeRule]] = {}
        for rule in self.rules:
            groups.setdefault(rule.shape, []).append(rule)
        scans = []
        for (_, filler, _), rules in groups.items():
            inner = {x for c in colours for x in c[1:]} | set(self.particle)
            inner |= {x for r in rules for o in r.objects for x in o}
            mixed = any(
                a.startswith(o) or a.endswith(o)
                for r in rules for q in rules if r is not q for a in r.objects for o in q.objects
            )
            if filler or mixed or heads & inner:
                scans += [[rule] for rule in rules]
            else:
                scans.append(rules)
        return scans


# The Chinese surveillance-caption vocabulary.
_COLOURS = ("黑色", "白色", "蓝色", "红色", "黄色", "灰色", "粉色", "绿色", "紫色", "棕色", "橙色", "银色", "金色")
_SHORT_COLOURS = ("黑", "白", "蓝", "红", "黄", "灰", "粉", "绿", "紫", "棕", "橙")
_TOPS = ("短袖", "长袖", "上衣", "衣服", "外套", "雨衣")
_LOGO = "(?:有[^，。；;]*?图标的|阿迪图标)?"
_RIDES = ("电动车", "自行车", "摩托车")
_MINORS = "(?:小孩|女孩|男孩|儿童)"
_REST = "[^，。；;]*"

CHINESE = Lexicon(
    # Separators, trim sets and wording replacements.
    comma="，",
    full_stop="。",
    caption_trim="，。；;、 ",
    query_trim="，；;。 ",
    separator_merges=(("，。", "。"), ("，，", "，")),
    separator_runs="[，；;]{2,}",
    particle="的",
    wordings=(("穿着", "穿"), ("带着", "戴"), ("背着", "背"), ("骑着", "骑"), ("的的", "的")),
    query_wordings=(("一个", ""), ("有阿迪图标的", "阿迪图标")),
    min_query_len=4,
    short_caption_len=45,
    # Colours, roles and the objects that may carry a colour.
    colours=_COLOURS,
    short_colours=tuple((c, c + "色") for c in _SHORT_COLOURS),
    roles=("mask", "helmet", "hat", "upper", "pants", "shoes", "bag", "vehicle", "windshield", "action"),
    rules=(
        AttributeRule("upper", "穿", _TOPS, filler=_LOGO),
        AttributeRule("upper", "穿", _TOPS, lead="穿", filler=_LOGO),
        AttributeRule("pants", "穿", ("裤子", "短裤")),
        AttributeRule("shoes", "穿", ("鞋子", "鞋")),
        AttributeRule("mask", "戴", ("口罩",), lead="戴"),
        AttributeRule("mask", "戴", ("口罩",)),
        AttributeRule("helmet", "戴", ("头盔",), lead="戴"),
        AttributeRule("helmet", "戴", ("头盔",)),
        AttributeRule("hat", "戴", ("帽子",), lead="戴"),
        AttributeRule("hat", "戴", ("帽子",)),
        AttributeRule("bag", "背", ("书包", "背包")),
        AttributeRule("bag", "拿", ("袋子", "手提袋")),
        AttributeRule("vehicle", "骑", _RIDES, lead="骑着?", colour_optional=True),
        AttributeRule("vehicle", "骑", _RIDES),
        AttributeRule("windshield", "有", ("挡风被",)),
    ),
    # Labels below min_query_len never survive tidying, as in the original
    # rules; lower min_query_len to get them.
    actions=(("抽烟", ("抽烟", "吸烟")), ("打电话", ("打电话", "接电话", "玩手机"))),
    action_role="action",
    rider_role="vehicle",
    shield_role="windshield",
    # Families sort finished phrases by content, pairs say which go together.
    families=(
        Family("upper", ("上衣", "短袖", "长袖", "衣服", "外套", "雨衣")),
        Family("pants", ("裤",)),
        Family("shoes", ("鞋",)),
        Family("mask", ("口罩",)),
        Family("helmet", ("头盔",)),
        Family("hat", ("帽子",)),
        Family("bag", ("书包", "背包", "袋")),
        Family("vehicle", _RIDES, needs="骑"),
        Family("windshield", ("挡风被",)),
        Family("action", ("抽烟", "打电话"), whole=True),
    ),
    family_pairs=(
        ("upper", "pants"),
        ("upper", "shoes"),
        ("pants", "shoes"),
        ("mask", "upper"),
        ("helmet", "upper"),
        ("hat", "upper"),
        ("bag", "upper"),
        ("upper", "vehicle"),
        ("pants", "vehicle"),
        ("helmet", "vehicle"),
        ("vehicle", "windshield"),
        ("action", "upper"),
        ("action", "vehicle"),
    ),
    # Words for people, background noise, clauses about others.
    subjects=("男子", "男人", "男孩", "女人", "女子", "女孩", "老人", "小孩", "儿童", "行人", "人"),
    default_subject="人",
    subject_aliases=(("行人", "人"),),
    noise_openers=("地上有", "路上有", "旁边有", "背景", "行走在", "走在", "站在", "位于"),
    noise_words=("斑马线", "网格路", "道路上", "马路上"),
    clause_rest=_REST,
    secondary_clauses=(
        "抱着?" + _REST + _MINORS + _REST,
        "旁边有" + _REST + "(?:人|男子|男人|女人|女子|女孩|男孩|小孩|儿童)" + _REST,
        "后座" + _REST + _MINORS + _REST,
        "载着?" + _REST + _MINORS + _REST,
    ),
    secondary_cues=("抱", "旁边有", "后座", "载"),
    # Caption shortening, applied in this order.
    compressions=(
        ("监控视角下，", ""),
        ("画面中，", ""),
        ("画面里，", ""),
        ("一个", ""),
        ("一位", ""),
        ("一名", ""),
        ("穿着", "穿"),
        ("身穿", "穿"),
        ("正在", ""),
        ("正", ""),
        ("的状态", ""),
        *((c + "的", c) for c in ("黑色", "白色", "蓝色", "红色", "黄色", "绿色", "灰色", "棕色", "紫色", "粉色")),
        ("在路上行走", "行走"),
        ("行走在路上", "行走"),
    ),
    # Which clauses and variants are worth keeping.
    person_terms=("人", "男子", "男人", "女士", "女人", "女子", "女孩", "男孩", "小孩", "骑手", "乘客"),
    visual_terms=(
        "上衣", "外套", "短袖", "长袖", "裤", "鞋", "口罩", "帽", "头盔", "书包", "背包", "挎包",
        "行李箱", "袋子", "手机", "自行车", "电动车", "三轮车", "车",
    ),
    actor_terms=("车",),
    background_terms=("地上", "路上", "斑马线", "网格线", "墙", "路桩", "轿车", "监控", "画面"),
    clause_split="[，,]",
    subject_split="[；;。]|，(?=旁边有|后面有|前面有|左侧|右侧|另一个|还有)",
    subject_cues="^(?:旁边有|后面有|前面有|还有)",
    # Words that mark a caption for review.
    review_keywords=("监控视角", "画面", "前方骑手", "后座乘客", "车辆细节", "穿搭", "姿态", "时间戳"),
)
