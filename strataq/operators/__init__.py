"""Question review, difficulty, generation and augmentation."""
