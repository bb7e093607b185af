"""Sheet ranges in A1 notation. Ranges are configuration literals, so this is driver side."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Cell:
    """A column's letters and a row; row 0 means that no row is given."""

    column: str
    row: int = 0

    @classmethod
    def parse(cls, text: str) -> Cell:
        letters = text.rstrip("0123456789")
        digits = text[len(letters) :]
        if any(ch.isdigit() for ch in letters):
            raise ValueError(f"invalid cell: {text!r}")
        return cls(letters, int(digits) if digits else 0)

    @property
    def column_no(self) -> int:
        """Position of the column, A being 1."""
        number = 0
        for letter in self.column:
            if not "A" <= letter <= "Z":
                raise ValueError(f"no column letters: {self.column!r}")
            number = number * 26 + ord(letter) - ord("A") + 1
        return number

    def __str__(self) -> str:
        return f"{self.column}{self.row}" if self.row else self.column


@dataclass(frozen=True)
class Range:
    """A window of cells, open towards the bottom where the end has no row."""

    start: Cell
    end: Cell

    @classmethod
    def parse(cls, text: str) -> Range:
        parts = text.split(":")
        if len(parts) != 2:
            raise ValueError(f"invalid range: {text!r}")
        return cls(Cell.parse(parts[0]), Cell.parse(parts[1]))

    @property
    def first_row(self) -> int:
        return max(self.start.row, 1)

    @property
    def last_row(self) -> int | None:
        return self.end.row or None

    @property
    def width(self) -> int:
        width = self.end.column_no - self.start.column_no + 1
        if width < 1:
            raise ValueError(f"range {self} has no columns")
        return width

    @property
    def column_names(self) -> list[str]:
        """Neutral names c1, c2, ... in sheet order."""
        return [f"c{n}" for n in range(1, self.width + 1)]

    def starting_at(self, row: int) -> Range:
        return replace(self, start=replace(self.start, row=row))

    def __str__(self) -> str:
        return f"{self.start}:{self.end}"
