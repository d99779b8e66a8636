"""Small vocabularies of words that occur in the test tables; real ones are parameters of the same kind."""

from __future__ import annotations

from ..operators.facets import FacetConfig, Rules
from ..operators.scoring import Lexicon
from ..operators.vocabulary import TermSet

WORDS = TermSet.of("words", ["the", "with", "les", "der", "que", "was"])
TARGETS = TermSet.of("targets", ["with", "dans", "sich", "los"])
ACTIONS = TermSet.of("actions", ["from", "une", "nicht", "por"])
WEIGHTS = {"the": 3, "les": 4, "der": 5}
STOPWORDS = ["the", "and", "les", "des", "der", "die", "que", "los"]

LEXICON = Lexicon(
    sets={
        "region_1": ("the", "with"), "region_2": ("les",), "region_3": ("der",), "source_hints": ("src7",), "activists": ("this",), "journalists": ("was",), "defenders": ("dans",), "repression": ("from", "une"),
        "legal_repression": ("nicht",), "specific_rights": ("are",), "human_rights": ("that",), "legal_context": ("by",), "events": ("for",), "hr_repression": ("ed", "edes"), "press": ("not",), "hr_actions": ("from", "by"),
        "targets": ("with", "this"), "noise": ("que",), "domestic": ("is",), "major_geo": ("und",), "routine_geo": ("mit",), "soft_topics": ("qui",), "other_topics": ("sur",), "strong_rights": ("be",), "prisoners": ("at",),
    },
    weights={"repression": {"from": 6, "une": 5}, "rights": {"are": 4}},
)

FACETS = FacetConfig(places={"the": "nord", "les": "ouest", "der": "est"}, actors={"presse": ("this", "was"), "juges": ("dans", "nicht")}, treatments={"arret": ("from", "une"), "proces": ("by", "por")}, inherits={"est": "juges"}, advocacy=("that",), source_hints=("src7",))
RULES = Rules(places=frozenset({"nord", "ouest"}), place_role="mention_secondaire", actors=frozenset({"presse"}), treatments=frozenset({"arret"}), need_relation=True)
