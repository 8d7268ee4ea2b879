"""Dictionary translation of closed vocabularies (calendar events, plan labels, majors).

The dictionaries are fixed values, longest phrases first where order matters.
Each translation is one fold of literal replacements, so it stays inside the
JVM expression engine.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalodge.functions.text import blank_to_null, let, quoted, title_case

HAN_RE = "[一-鿿]"

# ---- Fixed values: calendar phrases, applied in this order --------------------
CALENDAR_PHRASES = (
    ("equal consideration", "同等考虑截止"), ("census date", "退课统计日"),
    ("examination period ends", "考试期结束"), ("examination period", "考试期"),
    ("examinations", "考试"), ("exams", "考试"), ("exam", "考试"),
    ("resit examinations", "补考"), ("resits and deferrals", "补考与延考"),
    ("resit", "补考"), ("revision", "复习周"),
    ("teaching period", "授课期"), ("teaching block", "教学段"),
    ("teaching break", "期中假"), ("teaching starts", "开课"), ("teaching ends", "授课结束"),
    ("study period", "备考期"), ("reading week", "阅读周"),
    ("welcome week", "迎新周"), ("o-week", "迎新周"), ("orientation week", "迎新周"),
    ("orientation", "迎新"), ("induction", "入学引导"), ("campus arrivals", "到校报到"),
    ("winter teaching vacation", "寒假"), ("summer teaching vacation", "暑假"),
    ("summer student vacation", "暑假"), ("spring teaching vacation", "春假"),
    ("easter vacation", "复活节假期"), ("christmas vacation", "圣诞假期"),
    ("winter vacation", "寒假"), ("summer vacation", "暑假"), ("vacation", "假期"),
    ("public holiday", "公共假期"), ("bank holiday", "公共假期"), ("holiday", "假期"),
    ("university offices re-open", "学校办公室恢复办公"),
    ("university closed", "闭校"), ("closed", "闭校"), ("closure", "闭校"),
    ("graduations", "毕业典礼"), ("graduation", "毕业典礼"),
    ("summer session", "夏季学期"), ("winter session", "冬季学期"),
    ("summer research period", "夏季研究期"),
    ("autumn semester", "秋季学期"), ("spring semester", "春季学期"),
    ("autumn term", "秋季学期"), ("spring term", "春季学期"), ("summer term", "夏季学期"),
    ("first semester", "第一学期"), ("second semester", "第二学期"),
    ("semester", "学期"), ("term dates", "学期日期"),
    ("begins", "开始"), ("commences", "开始"), ("starts", "开始"),
    ("ends", "结束"), ("finishes", "结束"), ("returns", "返校"),
    ("results from", "成绩公布："), ("results", "成绩"), ("published", "公布"),
    ("dates when the university will be", "闭校日期："), ("teaching", "授课"),
    ("flexible learning week", "弹性学习周"), ("mid-semester break", "期中假"),
    ("re-open", "恢复开放"), ("international students’", "国际学生"),
    ("international students'", "国际学生"), ("weeks", "周"),
    ("spring", "春季"), ("summer", "夏季"), ("autumn", "秋季"), ("winter", "冬季"),
    ("last day to add", "加课截止："), ("last day to drop", "退课截止："),
    ("due date for payment", "缴费截止"),
    ("new year's day", "元旦"), ("australia day", "澳大利亚日"),
    ("anzac day", "澳新军团日"), ("good friday", "耶稣受难日"),
    ("easter day", "复活节"), ("easter monday", "复活节星期一"),
    ("king's birthday", "国王诞辰日"), ("labour day", "劳动节"),
    ("reconciliation day", "和解日"), ("canberra day", "堪培拉日"),
)

# ---- Fixed values: words of study-plan items, applied in this order -----------
PLAN_TERMS = (
    ("general education", "通识教育"), ("free electives", "自由选修"),
    ("free elective", "自由选修"), ("optional minors", "可选辅修"),
    ("optional minor", "可选辅修"), ("broadening discipline electives", "拓展学科选修"),
    ("recommended discipline electives", "推荐学科选修"),
    ("built environment electives", "建成环境选修"),
    ("engineering and technical management electives", "工程与技术管理选修"),
    ("discipline electives", "学科选修"), ("discipline elective", "学科选修"),
    ("computing electives", "计算机选修"), ("computing elective", "计算机选修"),
    ("prescribed electives", "指定选修"), ("prescribed elective", "指定选修"),
    ("technical electives", "技术选修"), ("professional electives", "专业选修"),
    ("electives", "选修课"), ("elective", "选修课"),
    ("thesis", "毕业论文"), ("capstone", "毕业设计"),
    ("industrial training", "实习"), ("work integrated learning", "带薪实习"),
    ("research project", "研究项目"), ("minor", "辅修"), ("major", "主修"),
    ("core courses", "核心课程"), ("core course", "核心课程"),
    ("specialisations", "专业方向"), ("specialisation", "专业方向"),
    ("masters project", "硕士项目"), ("coursework", "授课课程"),
    ("project", "项目"), ("courses", "课程"), ("course", "课程"),
    ("or", "或"), ("and", "和"),
)

# ---- Fixed values: majors, the first contained entry decides ------------------
MAJOR_TERMS = (
    ("mine geotechnical", "矿山岩土"), ("geotechnical", "岩土"),
    ("geoenergy and geostorage", "地热能与地质封存"), ("geoenergy", "地热能"),
    ("geostorage", "地质封存"), ("geo eng and eng geology", "地质工程与工程地质"),
    ("aerospace", "航空航天"), ("bioinformatics", "生物信息"),
    ("biomedical", "生物医学"), ("chemical product", "化工产品"),
    ("chemical", "化学"), ("civil", "土木"), ("computer networks", "计算机网络"),
    ("computer science", "计算机科学"), ("computer engineering", "计算机工程"),
    ("computer", "计算机"), ("electrical", "电气"), ("environmental", "环境"),
    ("mechanical", "机械"), ("mechatronic", "机电"), ("mechatronics", "机电"),
    ("mining", "采矿"), ("nuclear", "核"), ("petroleum", "石油"),
    ("photovoltaics and solar energy", "光伏与太阳能"), ("photovoltaics", "光伏"),
    ("renewable energy", "可再生能源"), ("renewable", "可再生能源"),
    ("robotics and mechatronics", "机器人与机电"), ("robotics", "机器人"),
    ("software", "软件"), ("structural", "结构"), ("surveying", "测绘"),
    ("telecommunications", "电信"), ("transport", "交通运输"),
    ("water wastewater and waste", "水与污废水"), ("water", "水"),
    ("quantum", "量子"), ("space systems", "空间系统"),
    ("adv manufacturing", "先进制造"), ("advanced manufacturing", "先进制造"),
    ("manufacturing", "制造"), ("food process", "食品加工"),
    ("food science and technology", "食品科学与技术"),
    ("food science and nutrition", "食品科学与营养"), ("food science", "食品科学"),
    ("energy systems", "能源系统"), ("embedded systems", "嵌入式系统"),
    ("systems and control", "系统与控制"), ("sustainable systems", "可持续系统"),
    ("security engineering", "安全工程"), ("cyber security", "网络安全"),
    ("engineering science", "工程科学"), ("space", "空间"),
    ("artificial intelligence", "人工智能"), ("database systems", "数据库系统"),
    ("information technology", "信息技术"), ("internetworking", "网络互联"),
    ("programming languages", "编程语言"), ("computational biology", "计算生物学"),
    ("project management", "项目管理"), ("photovoltaic", "光伏"),
    ("commerce specialisation", "商科方向"), ("commerce specialisations", "商科方向"),
    ("anatomy", "解剖学"), ("bioinformatics", "生物信息学"), ("genetics", "遗传学"),
    ("molecular and cell biology", "分子与细胞生物学"), ("biophysics", "生物物理学"),
    ("ecology and conservation", "生态与保育"), ("biology and biodiversity", "生物与生物多样性"),
    ("biotechnology", "生物技术"), ("chemistry", "化学"),
    ("climate systems science", "气候系统科学"), ("food science", "食品科学"),
    ("geography", "地理学"), ("earth science", "地球科学"),
    ("physical oceanography", "物理海洋学"), ("statistics", "统计学"),
    ("materials science", "材料科学"), ("microbiology", "微生物学"),
    ("immunology", "免疫学"), ("marine and coastal science", "海洋与海岸科学"),
    ("neuroscience", "神经科学"), ("pathology", "病理学"), ("pharmacology", "药理学"),
    ("physiology", "生理学"), ("physics", "物理学"), ("psychology", "心理学"),
    ("vision science", "视觉科学"), ("applied mathematics", "应用数学"),
    ("pure mathematics", "纯数学"), ("advanced statistics", "高级统计"),
    ("mathematics", "数学"), ("data science", "数据科学"),
    ("actuarial studies", "精算"), ("actuarial", "精算"), ("commerce", "商学"),
    ("economics", "经济学"), ("information systems", "信息系统"),
    ("accounting", "会计"), ("finance", "金融"), ("marketing", "市场营销"),
    ("international business", "国际商务"), ("business analytics", "商业分析"),
    ("taxation", "税务"), ("financial analysis", "金融分析"),
    ("applied economics", "应用经济学"), ("business", "商学"),
    ("medical studies doctor of medicine", "医学（本博连读）"),
    ("doctor of medicine", "医学博士"), ("public health", "公共卫生"),
    ("global health", "全球健康"), ("infectious diseases intelligence", "传染病情报"),
    ("reproductive medicine", "生殖医学"), ("optometry", "视光学"),
    ("clinical optometry", "临床视光学"), ("health data science", "健康数据科学"),
    ("womens health medicine", "女性健康医学"), ("mental health", "心理健康"),
    ("health leadership", "健康领导力"), ("exercise physiology", "运动生理学"),
    ("orientation and mobility", "定向与行动"), ("vision impairment", "视力障碍"),
    ("medicine", "医学"), ("health", "健康"),
    ("juris doctor", "法学博士（JD）"), ("master of laws", "法学硕士"),
    ("laws", "法学"), ("law", "法学"),
)
# Endings after which no "工程" is added to an engineering major.
COMPLETE_ENDINGS = (
    "工程", "技术", "科学", "系统", "方向", "能源", "安全", "制造", "智能", "语言",
    "网络", "生物学", "管理", "互联",
)

# Fixed value: award abbreviations at the end of a name stay untranslated.
DEGREE_SUFFIX_RE = (
    r"\s+((?:BA|BSc|BEng|MEng|MA|MSc|MSci|MRes|MEd|MBA|MMus|MLitt|MPhil|LLB|LLM|"
    r"BAcc|BFin|BMus|BASc|BN|BDS|MBBS|PhD|EngD|PgDip|PgCert|GradDip|MPA|MPH|"
    r"MA\(SocSci\)|MSc\(MedSci\)|MVLS)(?:\s*[/&]\s*[A-Za-z()]+)*)\s*$"
)
# Corrections of machine translations.
TRANSLATION_FIXES = (
    ("深层学习", "深度学习"),
    ("和东欧研究学校", "与东欧研究学院"),
    ("硕士学位", ""), ("学士学位", ""),
    ("耳机研究所", "耳科研究所"),
)
COURSE_CODE_RE = r"[A-Z]{2,4}\d{4}"
# -------------------------------------------------------------------------------


def replace_phrases(text: Column, phrases: Sequence[tuple[str, str]], whole_words: bool = False) -> Column:
    """Apply literal, case-insensitive replacements one after another."""
    edge = r"\b" if whole_words else ""
    return reduce(
        lambda out, pair: F.regexp_replace(out, f"(?i){edge}{quoted(pair[0])}{edge}", pair[1]),
        phrases,
        text,
    )


def calendar_zh(name: Column) -> Column:
    """Translate a calendar event name; NULL unless at most two English words are left."""
    out = replace_phrases(name, CALENDAR_PHRASES)
    # Term numbers.
    out = F.regexp_replace(out, r"\b[Tt](\d)([A-C]?)\b", "T$1$2")
    out = F.regexp_replace(out, r"学期 (\d)", "第$1学期")
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    return let(
        out, lambda t: F.when(t.rlike(HAN_RE) & (F.regexp_count(t, F.lit("[A-Za-z]{3,}")) <= 2), t)
    )


def degree_suffix(name: Column) -> Column:
    return F.regexp_extract(name, DEGREE_SUFFIX_RE, 1)


def translatable_body(name: Column) -> Column:
    """The part of a name that goes to translation: no award suffix, all-capitals made title case."""
    body = F.regexp_replace(name, DEGREE_SUFFIX_RE, "")
    shouted = (F.upper(body) == body) & (F.lower(body) != body)
    return F.trim(F.when(shouted, title_case(body)).otherwise(body))


def finish_translation(name: Column, translated: Column) -> Column:
    """Check and polish a translated body and put the award suffix back; NULL if it is unusable."""
    body = translatable_body(name)
    usable = translated.rlike(HAN_RE) & (
        F.char_length(translated) <= F.greatest(F.lit(60), 3 * F.char_length(body))
    )
    out = reduce(lambda t, fix: F.replace(t, F.lit(fix[0]), F.lit(fix[1])), TRANSLATION_FIXES, translated)
    lowered = F.lower(name)
    out = F.when(
        lowered.startswith("school of") & out.endswith("学校"), F.regexp_replace(out, "学校$", "学院")
    ).otherwise(out)
    out = F.when(
        lowered.startswith("division of"), F.replace(out, F.lit("司"), F.lit("部"))
    ).otherwise(out)
    out = F.regexp_replace(out, r"^[ ，。:：]+|[ ，。:：]+$", "")
    return F.when(usable, F.trim(F.concat_ws(" ", out, blank_to_null(degree_suffix(name)))))


def plan_label_zh(text: Column) -> Column:
    """Translate a plan item: codes stay, connectors and category words are replaced."""
    has_code = text.rlike(COURSE_CODE_RE)
    # Parts around the connectors, each trimmed, joined by single blanks.
    linked = F.regexp_replace(text, r"\s*\bor\b\s*", " 或 ")
    linked = F.regexp_replace(linked, r"\s*\band\b\s*", " 和 ")
    levelled = F.regexp_replace(text, LEVEL_RE, "$1级")
    words = let(
        replace_phrases(levelled, PLAN_TERMS, whole_words=True),
        lambda w: F.when((w != levelled) & w.rlike(HAN_RE), F.trim(F.regexp_replace(w, r"\s+", " "))),
    )
    return F.when(has_code, F.trim(linked)).otherwise(words)


# Patterns of plan file names and labels.
LEVEL_RE = r"(?i)\bLevel (\d)\b"
TERM_RE = r"(?i)\bT([123])\b.*?(20\d{2})"
NOT_A_SUBJECT = (r"^\d{4}$", r"(?i)^(bachelor|master)\b", "(?i)^1st yr")
SHORT_CODE_RE = r"^[A-Za-z]+\d*$"
CODE_IN_FRONT_RE = r"^[A-Za-z]{4,7}\d\s+"
BEHIND_RE = r"(?i)\s+(full|part)\s+time.*$"


def plan_variant_label(url: Column) -> Column:
    """'Major · T1 2026 入学' from the file name of a study plan."""
    name = F.coalesce(F.try_url_decode(F.element_at(F.split(url, "/"), -1)), F.lit(""))
    name = F.regexp_replace(name, r"\.pdf.*$", "")
    pieces = F.split(name, r"\s*-\s*-\s*|\s+-\s+|_{2,}|-{2,}")
    pieces = F.filter(
        F.transform(pieces, lambda s: F.trim(F.regexp_replace(s, r"[-_\s]+", " "))), lambda s: s != ""
    )
    return let(pieces, _label_of_pieces)


def _label_of_pieces(pieces: Column) -> Column:
    at = F.array_position(F.transform(pieces, lambda s: s.rlike(TERM_RE)), F.lit(True)).cast("int")
    piece = F.get(pieces, at - 1)
    term = F.concat(
        F.lit("T"), F.regexp_extract(piece, TERM_RE, 1), F.lit(" "), F.regexp_extract(piece, TERM_RE, 2), F.lit(" 入学")
    )
    kept = F.when(at > 0, F.slice(pieces, F.lit(1), at - 1)).otherwise(pieces)

    def is_subject(s: Column) -> Column:
        other = s.rlike("|".join(NOT_A_SUBJECT))
        return ~(other | ((F.char_length(s) <= 8) & s.rlike(SHORT_CODE_RE)))

    def last_of(rest: Column) -> Column:
        return F.coalesce(
            F.try_element_at(F.filter(rest, is_subject), F.lit(-1)), F.try_element_at(rest, F.lit(-1)), F.lit("")
        )

    major = F.trim(F.regexp_replace(let(kept, last_of), CODE_IN_FRONT_RE, ""))
    major = F.trim(F.regexp_replace(major, BEHIND_RE, ""))
    label = F.concat_ws(" · ", blank_to_null(let(major, title_case)), F.when(at > 0, term))
    return F.coalesce(blank_to_null(label), F.lit("培养计划"))


def _dictionary(entries: Sequence[tuple[str, str]]) -> Column:
    """A dictionary as one array literal, so that an expression carries it as a constant."""
    text = json.dumps([{"en": en, "zh": zh} for en, zh in entries], ensure_ascii=False)
    return F.from_json(F.lit(text), "array<struct<en:string,zh:string>>")


def major_zh(label: Column) -> Column:
    """Chinese name of a major: the first dictionary entry it contains decides."""
    low = F.lower(F.trim(F.regexp_replace(label, r"\s*·.*$", "")))
    endings = "(" + "|".join(COMPLETE_ENDINGS) + ")$"

    def named(low: Column) -> Column:
        first = F.get(F.filter(_dictionary(MAJOR_TERMS), lambda t: F.contains(low, t["en"])), F.lit(0))
        engineering = low.contains("engineering") | low.rlike(r"\beng\b")
        return let(
            first["zh"],
            lambda zh: F.when(engineering & ~zh.rlike(endings), F.concat(zh, F.lit("工程"))).otherwise(zh),
        )

    return let(low, named)


def plan_variant_zh(label: Column) -> Column:
    """Chinese variant label; the part behind the dot is kept as it is."""

    def put_together(text: Column) -> Column:
        tail = blank_to_null(F.trim(F.regexp_extract(text, r"·\s*(.+)$", 1)))
        return let(major_zh(text), lambda zh: F.when(zh.isNotNull(), F.concat_ws(" · ", zh, tail)))

    return let(label, put_together)
