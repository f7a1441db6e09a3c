"""Operations on training text: secrets, tokens, mixing, decontamination, near copies,
search, toxicity, repeated passages, quality and language-model scores."""
