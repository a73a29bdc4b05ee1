"""Word lists and patterns for tagging, as parameters with defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# The default word lists, in the order in which matches are reported.
ROUTES = (
    "黄巢", "玉符河", "怪坡", "药乡", "斗母泉", "七星台",
    "锦绣川", "红叶谷", "雪野湖", "鹊山", "龙洞", "藏龙涧",
    "百脉泉", "四门塔", "跑马岭", "五峰山", "灵岩寺",
    "黄河大堤", "泰安", "莱芜", "章丘",
    "北大赛", "黄巢拉练", "卧虎山", "金象山",
    "南新线", "软园线", "中心线", "洪楼线", "西校线",
    "雷达站", "海盗坡", "舜泰坡", "旅游路",
)
PROBLEMS = (
    "扎胎", "爆胎", "漏气", "蛇咬",
    "摔车", "蹭摔",
    "中暑", "抽筋", "低血糖", "晒伤", "失温",
    "链条断", "掉链", "链条卡",
    "刹车失灵", "蹭碟", "蹭圈", "刹车啸叫",
    "变速不准", "跳链", "变速卡",
    "断辐条", "偏摆", "龙跳", "拿龙",
    "异响", "共振",
    "脚踏松动", "中轴异响", "碗组松动",
    "货架断裂", "驮包松动",
)
ROLES = ("队长", "协理", "前站", "前骑", "前助", "队医", "技术员", "后骑", "摄影")
EVENT_TYPES = ("通知", "总结", "报名", "探路", "选拔", "训练", "比赛", "讨论", "公告", "记录", "心得")
ACTIVITY_TYPES = ("拉练", "远征", "体训", "行疆", "小队", "实践", "支教", "比赛", "日常训练", "晚会", "送老", "西瓜节")

# Cue categories with their words, and label patterns, in priority order.
CUES = {
    "proposal": ("建议", "提议", "提案", "方案", "是否", "拟"),
    "practice": ("流程", "规定", "安排", "执行", "报名", "分组", "制度", "规则"),
    "benefit": ("优点", "好处", "有利于", "便于", "提高", "避免", "保证"),
    "risk": ("问题", "风险", "缺点", "不足", "争议", "反对", "事故", "取消"),
    "outcome": ("结果", "总结", "复盘", "最终", "实际", "完成", "公示"),
}
LABELS = (
    r"第[一二三四五六七八九十百零〇0-9]+次[^，。\n]{0,12}执委会",
    r"[0-9]{4}[^，。\n]{0,12}执委会",
    r"(春季|秋季|暑期|寒假)[^，。\n]{0,8}执委会",
    r"理事会[^，。\n]{0,24}(通知|决议|任命|提醒)",
    r"财务(制度|总结|公开|报销)",
    r"会长[^，。\n]{0,8}(换届|选举|任命)",
    r"主席团[^，。\n]{0,12}(会议|通知|决议)",
)

# Boards by number, with name and category.
BOARDS = {
    2: ("活动专区", "日常·活动"),
    6: ("关于单车", "技术·装备"),
    18: ("灌水闲聊", "日常·闲聊"),
    24: ("心路骑迹", "日常·感悟"),
    27: ("车协众生相", "日常·众生相"),
    39: ("有事您说话", "日常·求助"),
    58: ("车协会刊", "日常·会刊"),
    70: ("路线攻略", "技术·路线"),
    112: ("散作满天星", "日常·老会员"),
    115: ("车协日记", "日常·日记"),
    25: ("2007年远征版", "远征·2007"),
    38: ("2008年远征版", "远征·2008"),
    45: ("2009年远征版", "远征·2009"),
    48: ("2010年远征版", "远征·2010"),
    53: ("2011年远征版", "远征·2011"),
    54: ("2012年远征版", "远征·2012"),
    69: ("2014年远征版", "远征·2014"),
    111: ("2015年远征版", "远征·2015"),
    114: ("2016年远征版", "远征·2016"),
    121: ("2019年远征版", "远征·2019"),
    122: ("2020年远征版", "远征·2020"),
    125: ("2021年远征版", "远征·2021"),
    137: ("2022年远征版", "远征·2022"),
    138: ("2022年行疆版", "行疆·2022"),
    139: ("2022年冬游版", "冬游·2022"),
    140: ("2023年远征版", "远征·2023"),
    141: ("2023年行疆版", "行疆·2023"),
    142: ("城市探险家", "实践·2023"),
    143: ("2024年远征版", "远征·2024"),
    145: ("2024年行疆版", "行疆·2024"),
    147: ("2024年实践版", "实践·2024"),
    148: ("2025年远征版", "远征·2025"),
    149: ("2025年行疆版", "行疆·2025"),
    151: ("2026年远征版", "远征·2026"),
    152: ("2026年支教版", "支教·2026"),
    15: ("版主申请/请辞", "站务"),
    16: ("新版申请", "站务"),
    26: ("站长办公室", "站务"),
}
NO_CATEGORY = "未分类"
NO_AUTHOR = "未知"
TIME_MARK = "发表于"
NOTICE = "提示信息"
SEASONS = "春秋暑寒"


@dataclass(frozen=True)
class Vocab:
    """Everything that tagging looks for; the lists decide order as well as content."""

    routes: tuple[str, ...] = ROUTES
    roles: tuple[str, ...] = ROLES
    problems: tuple[str, ...] = PROBLEMS
    event_types: tuple[str, ...] = EVENT_TYPES
    activity_types: tuple[str, ...] = ACTIVITY_TYPES
    cues: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(CUES))
    labels: tuple[str, ...] = LABELS


#: Frequent words of the Latin-script test tables in the place of the default lists.
LATIN = Vocab(
    routes=("the", "thion", "achlich", "ciónes", "réeux"),
    roles=("der", "que", "les", "and"),
    problems=("token", "license", "rights", "@"),
    event_types=("version", "the", "der", "de"),
    activity_types=("and", "und", "el", "la"),
    cues={"proposal": ("the", "der"), "practice": ("license", "rights"), "benefit": ("que", "qui"), "risk": ("token", "=")},
    labels=(r"[A-Z][a-z]+ [0-9]+", r"license[^,.\n]{0,12}", r"[A-Z]{3,}"),
)
