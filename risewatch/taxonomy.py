"""Keyword taxonomy: which names to look for and the category of each.

Any mapping ``category -> names`` works; :data:`DEFAULT` is the built-in one.
A name listed under two categories belongs to the later one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from risewatch.functions.text import sql_text

# The built-in names by category.
CATEGORIES = {
    "Languages": [
        "Python", "Rust", "Go", "TypeScript", "JavaScript", "Zig", "Kotlin", "Swift", "Elixir",
        "Haskell", "Ruby", "Java", "C++", "C#", "Scala", "Clojure", "Erlang", "OCaml", "F#", "Nim",
        "Crystal", "Julia", "R", "Lua", "Dart", "PHP", "Perl",
    ],
    "Frameworks": [
        "Next.js", "FastAPI", "Django", "Rails", "Spring", "Svelte", "Remix", "Astro", "Laravel",
        "Express", "NestJS", "Nuxt", "SvelteKit", "Flask", "FastHTML", "Litestar", "Hono", "Elysia",
        "Bun", "React", "Vue", "Angular", "Solid", "Qwik",
    ],
    "Tools": [
        "Docker", "Kubernetes", "Terraform", "dbt", "Kafka", "Airflow", "Prefect", "Grafana",
        "Prometheus", "Helm", "Ansible", "Pulumi", "Nix", "Git", "GitHub", "GitLab", "Nginx", "Caddy",
        "Traefik", "Redis", "Elasticsearch", "OpenTelemetry", "Jaeger", "Temporal", "uv", "ruff",
        "mypy", "Pydantic",
    ],
    "AI/ML": [
        "LLM", "GPT", "Claude", "Gemini", "PyTorch", "JAX", "Ollama", "RAG", "fine-tuning",
        "TensorFlow", "Hugging Face", "Llama", "Mistral", "Whisper", "Stable Diffusion", "RLHF",
        "LoRA", "QLoRA", "embeddings", "vector search", "transformer", "diffusion model",
        "multimodal", "agentic", "MCP",
    ],
    "Platforms": [
        "Supabase", "Vercel", "Railway", "Fly.io", "MotherDuck", "Neon", "PlanetScale", "Cloudflare",
        "AWS", "GCP", "Azure", "Render", "Netlify", "Heroku", "DigitalOcean", "Hetzner", "Tailscale",
        "Coolify", "Kamal",
    ],
    "Companies": [
        "Anthropic", "OpenAI", "Google DeepMind", "Mistral", "Hugging Face", "Databricks",
        "Snowflake", "HashiCorp", "JetBrains", "Grafana Labs", "Confluent", "dbt Labs", "Posit",
    ],
}

# Names that need more than a whole-word match.
PATTERNS = {
    "Go": r"\bGo\b(?!\s+(?:to|ahead|back|through|away|home|on|off|up|down|out|in|over|under))",
    "R": r"\bR\b(?=\s+(?:language|programming|package|cran|tidyverse|\d)|\s*$)",
}

_WORD_RUN = re.compile(r"\w+")


@dataclass(frozen=True)
class Taxonomy:
    """Names to detect, grouped by category, with optional patterns per name.

    ``patterns`` holds a regular expression for each name whose whole-word
    match is not good enough (it may use look-around and is matched without
    regard to case).
    """

    categories: Mapping[str, Sequence[str]]
    patterns: Mapping[str, str] = field(default_factory=dict)

    def category_of(self) -> dict[str, str]:
        return {name: category for category, names in self.categories.items() for name in names}

    def __len__(self) -> int:
        return len(self.category_of())

    def required_words(self, name: str) -> list[str] | None:
        """Lower-case words that any match of ``name`` contains as whole words.

        ``None`` means nothing is known about the matches of its pattern.
        """
        pattern = self.patterns.get(name)
        if pattern is None:
            return _WORD_RUN.findall(name.lower()) or None
        if _WORD_RUN.fullmatch(name) and pattern.startswith(rf"\b{name}\b"):
            return [name.lower()]
        return None

    def is_single_word(self, name: str) -> bool:
        """Whether matching ``name`` is the same as finding it among the words."""
        return name not in self.patterns and _WORD_RUN.fullmatch(name) is not None

    def dataframe(self, spark: SparkSession) -> DataFrame:
        """(keyword, category), one row per name.

        Literal rows, so the planner knows that they are few: of an RDD it knows no size, and
        a join with it would shuffle the other side by keyword.
        """
        rows = sorted(self.category_of().items())
        if not rows:
            return spark.createDataFrame([], "keyword string, category string")
        values = ", ".join(f"({sql_text(name)}, {sql_text(category)})" for name, category in rows)
        return spark.sql(f"SELECT * FROM VALUES {values} AS t(keyword, category)")


DEFAULT = Taxonomy(CATEGORIES, PATTERNS)
