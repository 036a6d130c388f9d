"""Profiles that papers are classified by.  A profile is a parameter; these are the ones in use."""

from __future__ import annotations

from typing import NamedTuple


class Profiles(NamedTuple):
    domains: dict[str, tuple[str, ...]]  # specialists in order of priority, then the general one
    modes: dict[str, tuple[str, ...]]  # in order of priority
    general: str
    fallback_mode: str
    contrast: tuple[str, tuple[str, ...]]  # a mode and the signals that force it, before
    intervention: tuple[str, tuple[str, ...]]  # this one
    generic: tuple[str, ...]


# Signals of the domains and modes, and what forces a mode.
DOMAINS = {
    "clinical_trial": (
        "clinical trial", "clinical study", "patient cohort", "human participants", "inclusion criteria", "exclusion criteria", "treatment regimen", "clinical endpoint", "adverse event", "epidemiology",
    ),
    "computational_biology": (
        "computational biology", "bioinformatics", "transcriptomics", "gene regulatory network", "network biology", "machine learning", "deep learning", "foundation model", "perturbation prediction",
    ),
    "wet_lab_molecular": (
        "wet lab", "cell biology", "molecular biology", "cancer biology", "developmental biology", "neuroscience", "immunology", "mechanobiology", "morphogenesis", "cell line", "reagent", "assay",
    ),
    "general_method": (
        "proposed method", "framework", "algorithm", "benchmark", "baseline", "ablation", "performance", "modeling", "mathematical model", "theoretical model", "simulation", "review",
    ),
}
MODES = {
    "causal_validation": (
        "knockout", "knockdown", "inhibition", "overexpression", "laser ablation", "rescue", "reconstitution", "necessary", "sufficient", "causal mechanism",
    ),
    "contrastive": (
        "same phenotype", "different mechanism", "context dependent", "opposite effect", "opposite conclusion", "in contrast", "whereas", "distinct mechanism", "rather than", "instead of", "alternative mechanism",
        "does not rely on",
    ),
    "methodological": (
        "benchmark", "baseline", "outperform", "state of the art", "ablation", "runtime", "memory usage", "data efficiency", "under the assumption", "modeling", "mathematical model", "theoretical model",
        "simulation", "assumption", "parameter sensitivity",
    ),
    "phenomenological": (
        "spatial transcriptomics", "spatial proteomics", "multiplex imaging", "microscopy", "spatial neighborhood", "tissue architecture", "ligand receptor", "cell cell communication", "colocalization",
        "spatial gradient",
    ),
}
ALTERNATIVES = ("different mechanism", "opposite effect", "opposite conclusion", "distinct mechanism", "alternative mechanism", "does not rely on")
INTERVENTIONS = ("knockout", "knockdown", "overexpression", "laser ablation", "reconstitution")
GENERIC = ("result", "experiment", "method", "limitation", "significant", "figure")

#: What an extraction must look for, by domain and by mode.
TARGETS = {
    "computational_biology": ("computational_pipeline", "datasets_used", "evaluation_metrics", "code_availability"),
    "wet_lab_molecular": ("experimental_system", "reagents", "perturbation_protocol", "assay_readouts", "replication"),
    "clinical_trial": ("study_design", "patient_cohort", "clinical_endpoints", "adverse_events", "statistical_analysis"),
    "general_method": ("proposed_method", "baselines", "evaluation_metrics", "ablations", "limitations"),
    "contrastive": ("boundary_conditions",),
    "methodological": ("evaluation_metrics", "baselines", "assumptions"),
    "causal_validation": ("causal_evidence_chain", "perturbation_protocol"),
    "phenomenological": ("spatial_location", "cell_cell_communication", "spatial_architecture"),
}

#: Other names of domains.
ALIASES = {
    "computational_bio": "computational_biology", "bioinformatics": "computational_biology", "biomedical_ai": "computational_biology", "experimental_biomedical": "wet_lab_molecular",
    "wet_lab": "wet_lab_molecular", "molecular_biology": "wet_lab_molecular", "cell_biology": "wet_lab_molecular", "clinical": "clinical_trial", "clinical_research": "clinical_trial",
    "clinical_study": "clinical_trial", "epidemiology": "clinical_trial", "general": "general_method", "generic": "general_method", "method": "general_method", "machine_learning": "general_method",
}
#: Words in a label that give its domain, tried in this order.
KEYWORDS = (
    ("clinical_trial", ("clinical trial", "clinical study", "clinical research", "epidemiology", "patient cohort", "human cohort")),
    (
        "computational_biology",
        (
            "computational biology", "computational pathology", "bioinformatics", "transcriptomics", "gene regulatory network", "network biology", "machine learning", "deep learning", "foundation model",
            "generative ai", "perturbation prediction",
        ),
    ),
    (
        "wet_lab_molecular",
        (
            "wet lab", "molecular biology", "cell biology", "cancer biology", "developmental biology", "neuroscience", "immunology", "mechanobiology", "morphogenesis", "bioelectric", "mitochondrial biology",
        ),
    ),
)

SCIENCE = Profiles(DOMAINS, MODES, "general_method", "methodological", ("contrastive", ALTERNATIVES), ("causal_validation", INTERVENTIONS), GENERIC)


def check(p: Profiles) -> None:
    """Raises ValueError if a profile lacks signals or names what isn't there."""
    if not all([*p.domains.values(), *p.modes.values()]):
        raise ValueError("every domain and mode needs a signal")
    if p.general not in p.domains or len(p.domains) < 2:
        raise ValueError("a general domain and a specialist are needed")
    missing = {p.fallback_mode, p.contrast[0], p.intervention[0]} - set(p.modes)
    if missing:
        raise ValueError(f"unknown modes: {sorted(missing)}")


def mandatory(domain: str, mode: str | None) -> tuple[str, ...]:
    """What to look for in a paper, each once, the domain's first."""
    return tuple(dict.fromkeys((*TARGETS[domain], *(TARGETS[mode] if mode else ()))))
