"""Display labels and formatting for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: code -> label ---------------------------------------------
LEVEL = {"UG": "本科", "PGT": "授课硕士", "PGR": "研究型", "foundation": "预科", "other": "其他"}
AUDIENCE = {"all": "全部申请者", "international": "国际学生", "home": "本土学生"}
DEADLINE_TYPE = {
    "equal_consideration": "UCAS 常规截止", "application": "申请截止", "deposit": "押金截止",
    "round": "分轮截止", "language_evidence": "语言证明", "other": "其他",
}
EVENT_TYPE = {
    "welcome_week": "迎新周", "teaching_period": "教学期", "reading_week": "阅读周",
    "exam_period": "考试季", "resit_period": "补考", "holiday": "假期",
    "closure": "闭校", "graduation": "毕业典礼", "other": "其他",
}
CONTENT_TYPE = {
    "week_topic": "每周主题", "reading": "阅读书单", "lecture_note": "讲义要点",
    "assignment": "作业/项目", "past_paper": "往年考试", "exam_tips": "备考经验",
    "student_review": "学生评价", "other": "其他",
}
SOURCE = {
    "official_public": "官网公开", "official_gated": "官方·登录墙内", "student": "学生提供",
    "agent": "第三方资料", "manual_other": "手动录入",
}
MODULE_TYPE = {"core": "必修", "optional": "选修", "elective": "任选"}
REGION = {"UK": "英国", "AU": "澳大利亚", "HK": "香港"}
CURRENCY = {"GBP": "£", "USD": "$", "EUR": "€", "CNY": "¥", "AUD": "A$", "HKD": "HK$", "SGD": "S$"}
REGION_RANK = ("UK", "AU", "HK")
# -------------------------------------------------------------------------------


def label(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code, the code itself when it has none."""
    chain = None
    for key, text in labels.items():
        chain = F.when(code == key, text) if chain is None else chain.when(code == key, text)
    return code if chain is None else chain.otherwise(code)


def verified_badge(verified: Column) -> Column:
    return F.when(verified, "✓ 已核实").otherwise("未核实")


def money_text(amount: Column, currency: Column) -> Column:
    """'£34,470' or 'A$1,234.5': at most three decimals, grouped thousands."""
    symbol = label(currency, CURRENCY)
    symbol = F.when(symbol == currency, F.concat(currency, F.lit(" "))).otherwise(symbol)
    return F.concat(symbol, F.call_function("format_number", amount, F.lit("#,##0.###")))


def days_left(deadline: Column, as_of: Column) -> Column:
    """Whole days until a deadline, a started day counts as a full one."""
    micros = F.unix_micros(deadline.cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))
    return F.ceil(micros / F.lit(86400000000.0)).cast("int")


def deadline_state(days: Column) -> Column:
    return F.when(days < 0, "past").when(days <= 30, "soon").otherwise("open")


def region_rank(region: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(r) for r in REGION_RANK]), region)
    return F.when(at == 0, 99).otherwise(at.cast("int"))


def assessment_text(items: Column) -> Column:
    """'80% Exam + 20% Essay' from array<struct<type, weight>>; NULL weights are left out."""
    parts = F.transform(
        items,
        lambda a: F.concat(
            F.coalesce(F.concat(a["weight"].cast("string"), F.lit("% ")), F.lit("")), a["type"]
        ),
    )
    return F.when(F.size(items) > 0, F.array_join(parts, " + ")).otherwise("考核未公布")
