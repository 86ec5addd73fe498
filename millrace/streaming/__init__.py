"""The stateless operators and the word counts under Structured Streaming."""
