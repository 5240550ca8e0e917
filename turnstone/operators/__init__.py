"""DataFrame operators over timed words, turns and work lists."""
