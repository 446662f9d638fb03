"""Table operators that need more than one built-in call."""
