"""Column layouts of each stage, declared once."""

from __future__ import annotations

from dataclasses import dataclass

DOCUMENT = "source_file string, md string"
SECTION = "source_file string, sec_pos long, h1 string, h2 string, h3 string, content string"
#: Keys of a training record's line, in order, and of the final set's.
RECORD = ("id", "instruction", "input", "output")
FINAL = ("instruction", "input", "output")

# Texts and limits that results depend on.
INSTRUCTION = (
    "You are a Senior Strategic Corporate Analyst. Summarize the report excerpt into a high-density English executive summary.\n"
    "STRICT COMMANDS:\n"
    "1. SOURCE FIDELITY: Use ONLY the provided text. Never use external knowledge or general history.\n"
    "2. FINANCIAL ACCURACY: Extract all material figures (revenue, costs, profit). Normalize units: convert 'tys.' (thousands) to M (millions). Example: 4,156,476k PLN -> 4,156.5M PLN. Always state the currency.\n"
    "3. STRATEGIC EVENTS: Explicitly include milestones like acquisitions (zakup), dividends, or board changes.\n"
    "4. TELEGRAPHIC STYLE: Write a continuous, professional narrative. Skip introductions, transitions, and bullet points. Use dense noun phrases.\n"
    "5. NO HALLUCINATION: If a specific data point (e.g. effective tax rate) is not in the text, omit it. Do not invent boilerplate or advisory names."
)
PREFIX = "DOKUMENT SEKCJA: "
TOC_MARKERS = (".......", "spis treści", "contents")
INSTRUCTION_MARK = "### Instruction:\n"
INPUT_MARK = "### Input:\n"
OUTPUT_MARK = "### Output:\n"


@dataclass(frozen=True)
class Config:
    """Parameters of a preparation run."""

    instruction: str = INSTRUCTION
    prefix: str = PREFIX
    toc_markers: tuple[str, ...] = TOC_MARKERS
    max_tokens: int = 6000
    overlap: int = 300
    min_characters: int = 800
    min_input: int = 200
    counter: str = "bpe_multi50k"
    skip_existing: bool = True
    seed: int = 42
    eos: str = "<|end_of_text|>"
    max_seq_length: int = 8192
