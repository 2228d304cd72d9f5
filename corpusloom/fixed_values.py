"""Names, wordings and thresholds that decide results.

Everything here must stay exactly as it is for outputs to be comparable with
datasets built earlier; the logic that uses the values lives elsewhere.
"""

# Instruction wording per inferred source type.
INSTRUCTION_BY_SOURCE_TYPE = {
    "solution": (
        "You are an expert analyst reviewing innovative solutions."
        " Provide: 'Brief solution description:', 'Methodology or approach:', 'Key results / impact achieved:', "
        "'Success factors / enablers:', 'Challenges encountered:', 'Transferability / replication potential:', "
        "and 'Recommendations for improvement or scaling:'."
    ),
    "experiment": (
        "You are a research analyst evaluating innovation experiments."
        " Outline: 'Hypothesis or research question:', 'Methodology and scope:', 'Key findings / evidence:', "
        "'Insights and learnings:', 'Limitations or considerations:', 'Implications for policy or practice:', "
        "and 'Next steps or further research suggestions:'."
    ),
    "action_plan": (
        "You are a practical advisor on implementing action plans."
        " Summarize: 'Action goal:', 'Learning questions:', 'Planned steps / timeline:', 'Resources needed / partners:', "
        "'Outcomes achieved (if noted):', 'Lessons learned:', and 'Follow-up actions / monitoring suggestions:'."
    ),
    "blog": (
        "You are a reflective analyst synthesizing blog and publication insights."
        " Produce a concise 'Summary of reflection:', 'Key lessons / insights:', 'Policy or practice implications:', "
        "and 'Suggested further reading or actions:'."
    ),
    "unknown": (
        "You are a helpful assistant. Summarize the document focusing on key points and recommended actions."
    ),
}

# Default instruction of the CSV converter, also the opening line of chunk prompts.
DEFAULT_INSTRUCTION = (
    "Please analyze the following text and provide a comprehensive summary "
    "highlighting the key points, main themes, and important details."
)

# Source-type rules in order: (substrings, label).
SOURCE_TYPE_RULES = [
    (("solution",), "solution"),
    (("experiment",), "experiment"),
    (("action", "plan"), "action_plan"),
    (("blog",), "blog"),
]
PROFILE_SOURCE_TYPE_RULES = [
    (("solution",), "solution_platform"),
    (("experiment",), "experiment_platform"),
    (("action",), "action_plan_platform"),
    (("blog", "publication"), "blogs"),
]
UNKNOWN_SOURCE_TYPE = "unknown"

# Candidate columns, in order of preference.
CHUNK_TEXT_COLUMNS = ["full_text", "text", "content", "body", "description", "sections"]
CONVERT_TEXT_COLUMNS = ["full_text", "text", "content", "body", "description"]
OUTPUT_COLUMNS = ["output", "label", "target", "summary", "response", "answer"]
PROFILE_TEXT_COLUMNS = ["content", "full_text", "title", "text", "description"]
EXPORT_OUTPUT_KEYS = ["merged_output", "merged_text", "final_output", "output", "generated", "completion"]
SECTION_TEXT_KEYS = ["txt", "text", "title", "html", "body", "content", "lead", "instruction"]
RESPONSE_PATHS = [
    "$.choices[0].message.content",
    "$.choices[0].text",
    "$.response",
    "$.generated_text",
    "$.text",
    "$.content",
    "$.output",
    "$.result",
]

# Prompt wording.
PROMPT_TEMPLATE = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n"
CHUNK_LABEL = "Text to analyze:"
FINAL_OPENING = [
    "Create a comprehensive summary by merging the following section summaries into a coherent, unified analysis.",
    "Focus on key themes, main points, and important details while avoiding repetition.",
]
FINAL_LABEL = "Section summaries to merge:"
FINAL_CLOSING = "Unified Summary:"
CHUNK_FALLBACK_OPENING = "Summarize the following text concisely:"
SUMMARIZE_OPENING = "Summarize the following text concisely, focusing on key points:"
SUMMARIZE_CLOSING = "Summary:"

# Limits and thresholds.
MAX_CHARS = 2000
OVERLAP = 200
SENTENCE_MIN_CHARS = 10
JACCARD_THRESHOLD = 0.7
ROW_TEXT_MIN = 10
DOCUMENT_TEXT_MIN = 20
LONG_FIELD_MIN = 40
NESTED_JSON_MIN = 50
TITLE_MIN, TITLE_MAX = 10, 100
FIELD_PREVIEW, OUTPUT_PREVIEW = 2000, 500
REQUIRED_HEADINGS = ["Summary:", "Key lessons:", "Recommended actions:"]
SIMILARITY_THRESHOLD = 0.18
CUTOFF_LEN = 512
LABEL_IGNORE = -100
WHITESPACE_TOKEN_BITS = 28
MAX_NEW_TOKENS = 200
PROFILE_ROWS, PROFILE_FIELD, PROFILE_SAMPLE, PROFILE_ITEM, PROFILE_HEAD, PROFILE_PIECE_MIN = 5, 200, 800, 400, 2000, 30
DEFAULT_MODEL, MODEL_ENV = "gpt2", "HF_FALLBACK_MODEL"
SAMPLING = {"do_sample": True, "temperature": 0.8, "top_p": 0.95, "repetition_penalty": 1.1, "no_repeat_ngram_size": 3}
TRANSIENT_WORDS = ["timeout", "connection", "network", "temporary"]
ERROR_PREFIX = "Error:"
MISSING_SOURCE = "unknown"
