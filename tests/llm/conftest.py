"""The session of the folder above serves these tests too."""
