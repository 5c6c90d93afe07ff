"""The same operators over folders that grow."""
