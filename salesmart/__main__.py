"""``python -m salesmart ...`` runs the command line (see ``salesmart.cli``)."""

from salesmart.cli import main

if __name__ == "__main__":
    main()
