"""Default rule packs: one book's titles, noise lines and contents, all of them replaceable arguments."""

from __future__ import annotations

# Anchored patterns of lines to be dropped, for stripped lines (first pack).
NOISE = [
    r"^ISBN \d",
    r"^定价[：:]\s*\d",
    r"^微信扫描",
    r"^上架建议",
    r"^9 \d{10,}",
    r"^新浪微博",
    r"^微\s*信[：:]",
    r"^淘宝店铺",
    r"^本社常年法律顾问",
    r"^凡有印装质量问题",
    r"^责任编辑",
    r"^责任印制",
    r"^出版发行",
    r"^地\s+址[：:]",
    r"^电\s+话[：:]",
    r"^传\s+真[：:]",
    r"^经\s+销[：:]",
    r"^印\s+刷[：:]",
    r"^开\s+本[：:]",
    r"^字\s+数[：:]",
    r"^印\s+张[：:]",
    r"^版\s+次[：:]",
    r"^印\s+次[：:]",
    r"^ICCTP",
    r"^Central Compilation",
    r"^著$",
    r"^译$",
    r"^陈言\s*译$",
    r"^柄谷行人\s*著$",
    r"^中央编译出版社",
    r"^定本$",
    r"^柄谷行人文学论集$",
    r"^柄谷行人$",
    r"^定价[：:]",
    r"^图书在版编目",
    r"^著作权登记号",
    r"^TEIHON",
    r"^by Kojin",
    r"^Originally published",
    r"^This simplified",
    r"^by arrangement",
    r"^责任编辑[：:]",
    r"^\d+页$",
    r"^第 \d+ 页$",
    r"^\d{3,4}\s*\|\s*定本",
    r"^\d{3,4}\s*\|\s*序文",
    r"^\d{3,4}\s*\|\s*漱石",
    r"^\d{3,4}\s*\|\s*麦克白",
    r"^\d{3,4}\s*\|\s*坂口",
    r"^\d{3,4}\s*\|\s*梦的",
    r"^\d{3,4}\s*\|\s*中上",
    r"^\d{3,4}\s*\|\s*文学",
    r"^\d{3,4}\s*\|\s*马克思",
    r"^\d{3,4}\s*\|\s*柳田",
    r"^\d{3,4}\s*\|\s*鲁迅",
    r"^\d{3,4}\s*\|\s*芥川",
    r"^\d{3,4}\s*\|\s*三岛",
    r"^\d{3,4}\s*\|\s*二叶亭",
    r"^\d{3,4}\s*\|\s*近代",
    r"^\d{3,4}\s*\|\s*翻译",
    r"^\d{3,4}\s*\|\s*森鸥外",
    r"^\d{3,4}\s*\|\s*亚历山大",
    r"^9 \d{6,}",
    r"^定本柄谷行人文文学论集 \[存疑\]",
    r"^作者简介$",
    r"^译者简介$",
    r"^序文 \| \d+$",
    r"^漱石试论 \| \d+$",
    r"^麦克白 \| \d+$",
    r"^坂口安吾 \| \d+$",
    r"^梦的世界 \| \d+$",
    r"^中上健次 \| \d+$",
    r"^文学的衰灭 \| \d+$",
    r"^马克思 \| \d+$",
    r"^柳田国男 \| \d+$",
    r"^鲁迅 \| \d+$",
    r"^芥川 \| \d+$",
    r"^三岛 \| \d+$",
    r"^二叶亭 \| \d+$",
    r"^近代文学 \| \d+$",
    r"^翻译的方法 \| \d+$",
    r"^森鸥外 \| \d+$",
    r"^亚历山大 \| \d+$",
]

# The second pack, used when sections are cleaned.
SECTION_NOISE = [
    r"^ISBN \d", r"^定价[：:]", r"^微信扫描", r"^上架建议", r"^9 \d{10,}", r"^新浪微博", r"^微\s*信[：:]", r"^淘宝店铺", r"^本社常年法律顾问", r"^凡有印装质量问题", r"^责任编辑", r"^责任印制", r"^出版发行",
    r"^地\s+址[：:]", r"^电\s+话[：:]", r"^传\s+真[：:]", r"^经\s+销[：:]", r"^印\s+刷[：:]", r"^开\s+本[：:]", r"^字\s+数[：:]", r"^印\s+张[：:]", r"^版\s+次[：:]", r"^印\s+次[：:]", r"^ICCTP", r"^Central Compilation",
    r"^著$", r"^译$", r"^陈言\s*译$", r"^柄谷行人\s*著$", r"^中央编译出版社", r"^定本$", r"^柄谷行人文学论集$", r"^柄谷行人$", r"^图书在版编目", r"^著作权登记号", r"^TEIHON", r"^by Kojin", r"^Originally published",
    r"^This simplified", r"^by arrangement", r"^\d+页$", r"^定本柄谷行人文文学论集 \[存疑\]", r"^作者简介$", r"^译后记$", r"^柄谷行人：移动的文学批评$", r"^.+\|\s*\d+$", r"^\d{1,4}$",
]
# Page headers, and lines that hold only a page number.
PAGE_MARKER = r"^## 第 \d+ 页"
PAGE_NUMBERS = [r"^第 \d+ 页$", r"^.+\| \d+$", r"^\d{1,4}$"]
# Removals over whole texts, line by line, in order.
MARKER_REMOVALS = [r"^## 第 \d+ 页\s*$", r"^\d{3,4}\s*\|.*$", r"^.+\|\s*\d+$", r"^第 \d+ 页$", r"^\d{1,4}$"]
# Marks of notes and of lines that a page break cut.
FOOTNOTE = r"^[①②③④⑤⑥⑦⑧⑨⑩]"
FOOTNOTE_MARKS = "①②③④⑤⑥⑦⑧⑨⑩"
BROKEN_LINE = r"//\s*$"
# Titles by level.
TITLES = {
    1: [r"^定本\s*柄谷行人文学论集", r"^序\s*文$", r"^第一部$", r"^第二部$"],
    2: [
        r"^漱石试论——意识与自然$", r"^夏目漱石论$", r"^麦克白论$", r"^森鸥外历史小说论$", r"^坂口安吾，其可能性的中心$", r"^梦的世界——岛尾敏雄$", r"^中上健次与福克纳$", r"^二叶亭四迷的翻译方法$",
        r"^近代文学的终焉$", r"^文学的衰灭$", r"^马克思，其可能性的中心$", r"^柳田国男试论$", r"^鲁迅的复古与革新$", r"^芥川龙之介论$", r"^三岛由纪夫论$", r"^亚历山大四重奏的辩证法$",
    ],
    3: [r"^一[、．.]", r"^二[、．.]", r"^三[、．.]", r"^四[、．.]", r"^五[、．.]", r"^\d+[、．.]"],
}
# Where a copyright part begins and ends.
COPYRIGHT_STARTS = [r"^定本\s*柄谷行人文学论集\s*\[存疑\]", r"^图书在版编目"]
COPYRIGHT_END = r"^序\s*文$"
FIRST_KEPT_PAGE = 6
PREAMBLE = "前言"
# The contents: title, part it belongs to, keywords.
CONTENTS = [
    ("序 文", None, ["序文"]),
    ("Ⅰ", None, []),
    ("《亚历山大四重奏》的辩证法", "part1", ["亚历山大四重奏"]),
    ("漱石试论——意识与自然", "part1", ["漱石试论"]),
    ("意义的病——麦克白论", "part1", ["麦克白"]),
    ("历史与自然——森鸥外论", "part1", ["森鸥外"]),
    ("关于坂口安吾的《日本文化私观》", "part1", ["坂口安吾"]),
    ("关于历史——武田泰淳", "part1", ["武田泰淳"]),
    ("Ⅱ", None, []),
    ("漱石的多样性", "part2", ["漱石的多样性"]),
    ("坂口安吾，其可能性的中心", "part2", ["坂口安吾，其可能性"]),
    ("梦的世界——岛尾敏雄", "part2", ["梦的世界", "岛尾敏雄"]),
    ("中上健次与福克纳", "part2", ["中上健次"]),
    ("翻译家四迷", "part2", ["翻译家四迷", "二叶亭四迷"]),
    ("文学的衰灭", "part2", ["文学的衰灭"]),
    ("初刊·底本一览", None, ["初刊", "底本"]),
    ("译后记", None, ["译后记"]),
    ("柄谷行人：移动的文学批评", None, ["移动的文学批评"]),
]
CONTENTS_START, CONTENTS_END, CONTENTS_TAIL = r"^《亚历山大四重奏》的辩证法\s*/\s*\d+$", r"^柄谷行人：移动的文学批评\s*/\s*\d+$", 2
#: Titles at which the repair flow cuts: those of the contents but for the two parts.
REPAIR_TITLES = [title for title, _, words in CONTENTS if words]
# Titles with a star.
STARRED = ["初刊·底本一览", "译后记", "柄谷行人：移动的文学批评"]
# Texts that stand for missing results, and the notes of replies that are not JSON.
NO_SUMMARY, NO_TRANSLATION, NO_EXTRACT, NOT_JSON = "未生成总结。", "未生成翻译。", "未生成原文抽取。", "Model did not return strict JSON."
# Headings of a report's parts, and the cover of the book: text, points.
REPORT_PARTS = ["处理信息", "内容总结", "中文翻译", "原文抽取"]
COVER = [("定本 柄谷行人文学论集", 28), ("柄谷行人 著", 16), ("陈言 译", 16), ("中央编译出版社", 14)]
COVER_LINE, CONTENTS_HEAD = "柄谷行人 著 / 陈言 译", "目 录"
# Styles of a PDF report (points, line height, space before and after, grey) and the font of Word files.
PDF_STYLES = {"title": (18, 24, 0, 0, 0.0), "h1": (14, 20, 10, 6, 0.0), "h2": (12, 18, 8, 4, 0.0), "body": (9.5, 14, 0, 0, 0.0), "meta": (8.5, 12, 0, 0, 0.27)}
PDF_MARGINS, PDF_SPACE, WORD_FONT = (16, 15), 4, "Microsoft YaHei"
CUT_REFERENCE, REFERENCE_CHARS = "\n...[embedded text truncated as reference]...", 8000
DPI, MAX_SIDE, JPEG_QUALITY, SLEEP, TARGET = 220, 3200, 92, 0.2, "简体中文"
TOTAL_PAGES, TRANSLATE_MINUTES, SUMMARY_MINUTES, BAR = 190, 0.35, 3, 40
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tif", ".tiff"]
# Model providers.
PROFILE_COLUMNS = "core string, api_key_env string, base_url_env string, model_env string, default_base_url string, default_model string, token_param string, default_vision_detail string, supports_json_mode boolean, supports_vision_detail boolean, supports_image_input boolean, api_key_header string, context_window_tokens int, default_ocr_max_tokens int, default_translate_max_tokens int, default_summary_max_tokens int, default_translation_chunk_chars int, default_summary_chunk_chars int, thinking string, reasoning_effort string, native_http boolean, api_style string"
PROFILES = [
    ("seed", "SEED_API_KEY", "SEED_BASE_URL", "SEED_MODEL", "https://ark.cn-beijing.volces.com/api/v3/responses", "doubao-seed-2-0-lite-260215", "max_tokens", "xhigh", True, True, True, "authorization", None, 12000, 12000, 8000, 16000, 24000, None, None, True, "responses"),
    ("mimo", "MIMO_API_KEY", "MIMO_BASE_URL", "MIMO_MODEL", "https://token-plan-cn.xiaomimimo.com/v1", "mimo-v2.5", "max_completion_tokens", "high", True, False, True, "api-key", 1048576, 131072, 131072, 131072, 120000, 180000, "enabled", None, True, "chat"),
    ("deepseek", "DEEPSEEK_API_KEY", "DEEPSEEK_BASE_URL", "DEEPSEEK_MODEL", "https://api.deepseek.com", "deepseek-v4-pro", "max_tokens", "high", True, False, False, "authorization", 1000000, 12000, 384000, 384000, 800000, 850000, "enabled", "high", False, "chat"),
]
