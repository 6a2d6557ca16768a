"""Named query plans (the registered queries) and their independent SQL oracles."""
