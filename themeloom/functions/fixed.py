"""Fixed values of the coding workflow.

These strings, patterns and thresholds define the file formats and the rules; results are only
right when they are exactly these.
"""

# Column names of a coding file and its header line.
CODE_COLUMN = "分类"
QUOTE_COLUMN = "检索词"
CODING_HEADER = "分类,检索词"

# Fixed value: characters removed from both ends of a quote.
OUTER_PUNCTUATION = " \t\r\n,，.。!！?？:：;；'\"“”‘’()（）[]【】{}<>《》、…-—"

# Fixed value: whitespace that a normalised review collapses to one blank. The class is spelled out
# because regex ``\s`` differs between engines outside ASCII.
WHITESPACE_RUN = (
    r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# Fixed value: the same characters as a plain list, for trimming.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Coding file names and the marks around a batch entry.
CODING_FILE_PATTERN = r"^batch_(\d+)(?:_(.+))?\.csv$"
ENTRY_PATTERN = r"^\[ID:(.*?)\] \[rating:(.*?)\] ?(.*)$"
ENTRY_START_TEXT = "[ID:"
ENTRY_START = r"(?m)^\[ID:"
THEME_MARK = "--- 主题："
THEME_PATTERN = r"\A--- 主题：(.*?) ---"

# Texts that mark a knowledge layer as still being the template.
PLACEHOLDER_MARKERS = (
    "（初始为空，首批编码后填入）",
    "（初始为空，首批完成后根据需要追加）",
    "版本**：v0.0（初始状态，未开始编码）",
    "已处理批次**：无",
)

# Banners of an assembled prompt, and its closing instruction.
# The unused pool begins with these lines, or says that nothing is left.
UNUSED_HEADER = (
    "# 未使用数据(仅供参考，非批次文件)",
    "# 这里是当前剩余、尚未进入任何批次的评论。",
    "# 每次运行 01_sampling_data.py 后本文件会被刷新。",
)
UNUSED_NONE = "(无剩余数据)"

PROMPT_RULE = "======================================="
PROMPT_TITLES = (
    "【第1层:编码规则与方法论】",
    "【第2层:当前编码本(研究者已确认)】",
    "【第3层:编码决策历史】",
    "【第4层:本批聚焦指令】",
)
PROMPT_BATCH_TITLE = "【本批待编码数据:批次 {batch_id}】"
PROMPT_START_TITLE = "【任务启动】"
PROMPT_START_TEXT = (
    "请按照第1层\"工作流约定\"的步骤1,先输出【批次阅览报告】，\n"
    "不要直接输出编码。等待研究者确认方向后再进行编码。\n"
)
STAGES = ("inductive", "deductive")

# Fixed value: code given to reviews that match nothing in the deductive stage.
OTHER_CODE = "其他"

# Thresholds.
SATURATION_WINDOW = 3
SATURATION_FAR = 5
SATURATION_TRENDING = 3
STOP_RULE_NEW_CODES = 2
THIN_CODE_QUOTES = 3
CODE_NAME_CHARS = 5
THEME_CODES_MIN = 3
THEME_CODES_MAX = 8
OUT_OF_SCOPE_WARNING = 0.25
GAP_OTHER_BELOW = 0.10
GAP_ITERATE_ABOVE = 0.20
GAP_RUN = 3
GOLD_STABLE = 0.90
GOLD_MILD = 0.70
BLOAT_BATCHES = 5
BLOAT_CODES = 40
MIN_SAMPLES = 3
