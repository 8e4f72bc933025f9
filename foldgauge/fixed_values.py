"""Fixed values.

Everything in this module is a value that results depend on literally: label names, default
parameters, prompt texts, replacement marks, regular expressions and output names. None of it is logic.
Regular expressions are written for ``java.util.regex``, which is what Spark's ``regexp_*`` functions use.
"""

# --- labels and run parameters (fixed values) ---------------------------------------------------
LABELS = ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")

SEED = 42
EXEMPLAR_SEED = 0
SAMPLE_SIZE = 8000
N_FOLDS = 5
VAL_RATIO = 0.10
DECISION_THRESHOLD = 0.5
POS_WEIGHT_CLIP = 50.0
EPOCHS = 4
MAX_TOKENS = 512
MAX_PROMPT_CHARS = 800
TRUNCATION_MARK = " ..."
CLEAN_NEGATIVES = 2
PROGRESS_EVERY = 50

# --- reply token budgets (fixed values) ---------------------------------------------------------
NUM_PREDICT = 64
NUM_PREDICT_REASONING = 512
NUM_PREDICT_THINK = 2048
REASONING_TAGS = ("gpt-oss", "deepseek-r1", "qwq", "o1")

# --- model names (fixed values) -----------------------------------------------------------------
CHAT_NAMES = {
    "llama3": "llama3:8b",
    "qwen": "qwen2.5:7b-instruct",
    "phi3": "phi3:mini",
    "mistral": "mistral:latest",
    "oss": "gpt-oss:latest",
}

# --- run directory names (fixed values) ---------------------------------------------------------
ENCODER_PREFIX = "bert_"
CHAT_PREFIX = "llm_"
MODES = ("finetune", "zero_shot", "few_shot")
MACRO_ROW = "MACRO_F1"
MICRO_ROW = "MICRO_F1"

# --- prompt texts (fixed values) ----------------------------------------------------------------
SYSTEM_PROMPT = (
    "You are a strict multi-label content moderation classifier. "
    "Given an internet comment, decide for EACH of these six categories whether the comment belongs to it: "
    "toxic, severe_toxic, obscene, threat, insult, identity_hate. "
    "Definitions: "
    "(toxic) rude, disrespectful, or unreasonable language likely to make someone leave a discussion; "
    "(severe_toxic) extremely aggressive, hateful, or violent content; "
    "(obscene) profanity, sexual content, or vulgar language; "
    "(threat) statements expressing intent to harm a person or group; "
    "(insult) targeted personal attacks or demeaning statements; "
    "(identity_hate) hate or prejudice toward a person/group based on race, ethnicity, religion, gender, sexual orientation, disability, or nationality. "
    "Multiple labels may apply at once. Output ONLY one line containing a single JSON object with exactly these six integer keys "
    "(values 0 or 1) and no other text, no explanation, no markdown: "
    '{"toxic":0|1,"severe_toxic":0|1,"obscene":0|1,"threat":0|1,"insult":0|1,"identity_hate":0|1}'
)
ZERO_SHOT_PREFIX = "Classify the following comment.\n\nComment: "
FEW_SHOT_HEADER = "Here are labeled examples. After them, classify the new comment.\n\n"
FEW_SHOT_TEXT_PREFIX = "Comment: "
FEW_SHOT_JSON_PREFIX = "\nJSON: "
FEW_SHOT_EXEMPLAR_END = "\n\n"
FEW_SHOT_QUERY_PREFIX = "Now classify this comment.\n\nComment: "
PROMPT_SUFFIX = "\n\nJSON:"
TEMPLATE_PLACEHOLDER = "<<COMMENT_TEXT>>"

# --- cleaning rules, in the order they apply: name, pattern, replacement (fixed values) ----------
# @B stands for one blank, @N for any other character; each engine has its own class for them.
CLEANING = (
    ("html_tag", r"<[^>]+>", " "),
    ("user_link", r"(?i)\[\[@B*(?:User|User talk|Special:Contributions)@B*:[^\]]*\]\]", " <USER> "),
    ("wiki_template", r"\{\{[^{}]*\}\}", " "),
    ("wiki_heading", r"={2,}@B*([^=]+?)@B*={2,}", r" \1 "),
    ("wiki_link", r"\[\[([^\]|]+?)(?:\|[^\]]+)?\]\]", r"\1"),
    ("signature", r"~{3,}", " "),
    ("url", r"(?i)(?:https?://|www\.)@N+", " <URL> "),
    ("ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", " <IP> "),
    ("blank_run", r"@B+", " "),
)
ZERO_WIDTH = "[​-‍⁠﻿]"
# Java's \s, even with (?U), leaves out U+001C..U+001F, which count as blanks here.
BLANK = r"[\s\x1c-\x1f]"
NON_BLANK = r"[^\s\x1c-\x1f]"
BLANKS = rf"(?U){BLANK}+"
BLANK_ENDS = rf"(?U)^{BLANK}+|{BLANK}+\z"

# --- reply patterns (fixed values) --------------------------------------------------------------
FENCE_OPEN = r"^```(?:json)?"
FENCE_CLOSE = r"```\z"
JSON_OBJECT = r"\{[^{}]*\}"
LABEL_DIGIT = rf'(?iU)"{BLANK}*\Q%s\E{BLANK}*"{BLANK}*:{BLANK}*([01])'
