"""The three jobs: build the training base, train, score."""
