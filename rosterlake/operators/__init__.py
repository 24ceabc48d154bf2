"""DataFrame operators that one built-in call does not express safely at scale."""
