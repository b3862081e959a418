"""Patterns, names and marks of the data formats that this engine reads, checks and writes.

They are given, not designed: results are right only with exactly these values.
"""

import ast

# What redaction, secret scanning and patch detection look for.
SECRET = r"(?U)\b(?:sk-[A-Za-z0-9_-]{16,}|gh[oprsu]_[A-Za-z0-9]{20,}|hf_[A-Za-z0-9]{20,}|AKIA[A-Z0-9]{16})\b"
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
WINDOWS_HOME = r"(?i)\b[A-Z]:\\Users\\[^\\\s]+"
POSIX_HOME = r"(?<![\w/])/(?:home|Users)/[^/\s]+"
ANSI = r"\x1b\[[0-?]*[ -/]*[@-~]"
DIFF = r"(?mdU)^(?:diff --git |@@\s+-\d|---\s+\S+\n\+\+\+\s+\S+)"
NUMBER = r"(?U)\b\d+(?:\.\d+)?\b"
TOKEN = r"(?U)(\w+|[^\w\s])"
TOOL_CUT = "\n<tool_output_truncated_head_tail>\n"

# Roles and the names they go by.
ROLES = {
    "human": "user", "user": "user", "system": "system", "assistant": "assistant", "gpt": "assistant",
    "model": "assistant", "tool": "tool", "function": "tool", "tool_result": "tool",
}

# Keys of raw rows, in the order in which they are asked.
MESSAGE_KEYS = ("messages", "messages_json", "conversations", "conversation", "trajectory", "trace", "transcript", "chatml")
WRAPPED_KEYS = ("messages", "steps", "events")
ROLE_KEYS = ("role", "from", "speaker", "type")
CONTENT_KEYS = ("content", "value", "text", "message", "output")
OUTPUT_KEYS = ("output", "response", "answer", "completion", "assistant_response")
SYSTEM_KEYS = ("system", "system_prompt")
PROMPT_KEYS = ("prompt", "instruction", "task", "question", "user_prompt", "input")
RESPONSE_KEYS = ("response", "answer", "completion", "output", "assistant_response")
REASONING_KEYS = ("reasoning_content", "analysis", "thinking")
ID_KEYS = ("id", "uuid", "example_id", "question_id", "instance_id", "session_id", "request_id")
GROUP_KEYS = ("repository_id", "repo_id", "repository", "repo", "project", "session_id", "conversation_id", "request_id")
HOLDOUT_KEYS = ("question_id", "instance_id", "session_id", "repository_id")
PATCH_KEYS = ("gitdiff", "patch", "diff")
SUCCESS_KEYS = ("verified_success", "success", "resolved", "tests_passed", "passed", "patch_applied")
SUCCESS_WORDS = ("true", "yes", "passed", "success", "resolved")

# What a snippet may not contain, and what it may not call.
BANNED_NODES = (ast.Import, ast.ImportFrom, ast.ClassDef, ast.AsyncFunctionDef, ast.With, ast.AsyncWith, ast.Global)
BANNED_CALLS = frozenset((
    "__import__", "breakpoint", "compile", "delattr", "dir", "eval", "exec", "getattr",
    "globals", "help", "input", "locals", "memoryview", "open", "setattr", "vars",
))

# Licenses of sources that may be used.
LICENSES = ("apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "isc", "mit", "project-generated")
