"""Rule vocabularies as data. All lists are ordered; where rules are ordered, the first hit wins."""

# Page patterns (any line, any case) and the reason each one gives.
PAGE_PATTERNS = (
    (r"THE SPECIFICATIONS AND INFORMATION REGARDING THE PRODUCTS", "Legal notice"),
    (r"Cisco and the Cisco logo are trademarks", "Trademark notice"),
    (r"^CONTENTS\s*$", "Table of contents header"),
    (r"^PREFACE\s+Preface\s+", "Preface header"),
    (r"This preface includes the following sections", "Preface intro"),
    (r"^Reference Preface Map here", "Preface placeholder"),
    (r"^Audience\s*$", "Audience section"),
    (r"This publication is for network administrators", "Audience description"),
    (r"^Document Conventions\s*$", "Document conventions"),
    (r"^Documentation Feedback\s*$", "Documentation feedback"),
    (r"^Related Documentation for Cisco Nexus", "Related documentation"),
    (r"^Communications, services, and additional information", "Communications section"),
    (r"^Cisco Bug Search Tool\s*$", "Bug search section"),
    (r"^INDEX\s*$", "Index header"),
    (r"^I\s*N\s*D\s*E\s*X\s*$", "Index header (spaced)"),
)
FIRST_PAGES = 2
FIRST_PAGES_REASON = "Cover or legal page (first two pages)"
SPARSE_CHARS = 200
FEW_LINES = 3

# Line shapes.
CHAPTER_HINT = r"^CHAPTER\s+\d+"
CHAPTER_MARKER = r"^C\s+H\s+A\s+P\s+T\s+E\s+R\s+(\d+)\s*$"
TOC_BULLET = r"^\s*•\s*(.+?),\s*on\s+page\s+\d+\s*$"
NOTE_WORD = "Note"
CLI_PROMPT = r"(switch|router)\s*[#(>]"
HINT_OPENERS = ("The ", "A ", "This ")
CONTENT_OPENERS = ("The ", "A ", "This ", "Cisco ", "For ", "To ", "When ", "If ", "You ")
NON_HEADER_PREFIXES = (
    "step ", "example", "procedure", "purpose", "command or action", "configure terminal", "table ", "figure ",
    "before you begin", "summary steps", "detailed steps", "what to do next", "on page ", "this chapter", "this section",
)

# The code fence around a response.
FENCE_START = r"^```(?:json)?\s*\n?"
FENCE_END = r"\n?```\s*\z"

# Rules on subsection titles.
PRODUCT_TITLE = r"^(N\d+K[-A-Z0-9]+|SAL\d+[A-Z0-9]+|C\d+[A-Z0-9]+|SUP-?[AB]\+?)$"
LOG_TITLE = (
    r"^(Module\s+\d+\s+(powered\s+down|powered\s+up|detected)|Manual\s+power-on\s+of\s+Module|Service\s+\".*?\"\s+\(PID\s+\d+\)"
    r"|\d{4}\s+\w{3}\s+\d+\s+\d+:\d+:\d+\s+switch|switch\(config\)#|switch#)"
)
STATUS_VALUES = (
    "active", "standby", "offline", "initializing", "unknown", "failed", "standby (failed)", "at bios", "not present",
    "ha standby", "ha standby (failed)", "active with ha standby", "active with no standby", "shutting down",
    "ha switchover in progress", "ha synchronization in progress", "active with failed standby", "other", "yes", "no", "ok",
    "na", "n/a", "true", "false",
)
SYSTEM_STRINGS = (
    "gnu grub", "loader version", "reset reason registers", "performing memory detection", "filesystem type", "boot loader",
    "bios found", "numcpus", "pmcon_1", "pmcon_2", "pmcon_3", "pm1_sts", "status 61", "status 62", "status 9f", "status 9e",
    "status 9a", "status 98", "status 90", "cisco ide", "serial port parameters", "testing 1 dram patterns", "total mem found",
    "memory test complete", "raw time read from hardware clock", "writing reset reason", "nx9 sup ver", "current standby sup",
    "pci devices enumeration", "iofpga found", "booting from primary rom",
)
TABLE_HEADERS = (
    "related topic", "document title", "mibs link", "convention", "description", "step", "command or action", "purpose",
    "feature", "maximum number", "modules", "mibs", "mib link", "changed in release", "where documented",
)
SENTENCE_STARTERS = (
    "this", "if", "to", "when", "wait", "copies", "saves", "auto-copy", "for", "you", "the", "there", "a", "an", "use",
    "begins", "enters", "issues", "initiates", "performs", "configures", "returns", "specifies", "forces", "enables",
    "disables", "includes", "refers", "allows", "provides", "supports", "requires", "permits", "displays", "verifies",
)
TITLE_KEYWORDS = (
    "Redundancy", "Restart", "Restartability", "Switchover", "Failure", "Module", "Protocol", "Verifying", "Replacing",
    "Configuring", "Configuration", "Troubleshooting", "Compatibility", "Mechanism", "Characteristic",
)
TITLE_END_KEYWORDS = ("Redundancy", "Restarts", "Switchovers", "Failures", "Mechanisms", "Characteristics", "Modules", "Cards", "Services")
DIGITS_SYMBOLS = r"^[\d\.\-\s]+$"
ENOUGH_WORDS = 20

# Words of a title or text that suggest a type.
TROUBLE_TITLES = ("troubleshooting", "verifying", "replacing", "displaying", "switchover possibilities", "restart", "failure", "recovery")
CONFIG_TITLES = ("configuring", "configuration", "installing", "enabling", "config")
CONFIG_TEXTS = ("configure terminal", "switch(config)")
KB_TYPES = ("config", "theory", "troubleshooting")
PLATFORM_PREFIXES = ("nx-os-", "nxos-", "ios-xe-", "iosxe-")
TYPE_SUFFIXES = ("-theory", "-config", "-troubleshooting")
SEVERITIES = ("critical", "major", "minor")

# Headings each class of entry must have, and what a verifier's problems are called.
REQUIRED_HEADINGS = {
    "config": ("Syntax", "Notes"),
    "theory": ("Overview", "Key Concepts", "How It Works", "Notes"),
    "troubleshooting": ("Purpose", "Procedure", "Expected Output", "Notes"),
}
PROBLEM_CATEGORIES = (
    "hallucination", "contradiction", "distortion", "numeric_error", "command_invention", "specification_invention", "scope_creep", "citation_error",
)

# What a section is skipped for, what an entry must keep to and what a verifier must look at, in our words.
SKIP_RULES = (
    "it only points to another document or section",
    "it is a list of MIBs or references",
    'its title is "Additional References"',
    "it has fewer than 50 words of substance",
    "it is a bare table without explanation or commands",
)
FIDELITY_RULES = (
    "State only what the section states; add no general knowledge and no advice of your own.",
    "Keep numbers, commands, model names and limits exactly as they stand.",
    "Replace addresses, names and other values of an example by placeholders in angle brackets.",
    "Keep each note of the section below the heading Notes.",
)
MUST_CHECK = (
    "every number of the entry stands in the text",
    "every command of the entry stands in the text",
    "every product or model name of the entry stands in the text",
    "every must, should, always and never of the entry is supported by the text",
)
USEFUL_WORDS = 50
STRONG_WORDS = ("must", "should", "always", "never")

# Messages of rows that can't be used.
NO_OBJECT = "No JSON object found in response"
BAD_JSON = "Invalid JSON in response: "
NOT_AN_OBJECT = "Response is not a JSON object"
NO_DECISION = "Missing 'decision' field"
BAD_DECISION = "Invalid decision: "
MALFORMED_CATEGORY = "malformed_llm_output"
BAD_PROBLEM = "Unexpected problem entry type: "
