"""The lexicon's six tables as DataFrame plans."""

from .modes import Options, categories, characters, english_words, phonetic_dictionary, readings, synonyms

__all__ = ["Options", "categories", "characters", "english_words", "phonetic_dictionary", "readings", "synonyms"]
