"""What tasks do with a tar archive: find where its ranges begin, or stream its files out.

Only the standard library and Arrow are used here, and the module travels to the executors with
the functions, so the package need not be installed there.
"""

import gzip
import io
import lzma
import os
import sys
import tarfile
import zlib
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUFFER_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000
# How far before a range the search for a header starts: further than headers for long names reach.
LOOK_BACK = 64 << 10
# An Arrow string holds less than this.
MEMBER_BYTES = (1 << 31) - 1

DAMAGED = (tarfile.TarError, EOFError, gzip.BadGzipFile, zlib.error, lzma.LZMAError)


def locate(path):
    """The storage of a path as Spark reports it, and its name there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    uri = "s3" + path[3:] if path.startswith("s3a:") else path
    return fs.FileSystem.from_uri(quote(uri, safe=":/@"))


def open_raw(path):
    """An unbuffered, seekable file for a path as Spark reports it."""
    store, name = locate(path)
    return store.open_input_file(name)


def open_path(path):
    """The same file, buffered."""
    return io.BufferedReader(open_raw(path), BUFFER_BYTES)


def is_hidden(name):
    """Whether Spark's listings pass over files and folders of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def entries(folder):
    """(path, length) of what stands in a folder, for folders no length; links that lead nowhere are left out.

    A local folder is never held as a whole.
    """
    store, name = locate(folder)
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(name) as found:
            for entry in found:
                try:
                    length = None if entry.is_dir() else entry.stat().st_size
                except FileNotFoundError:
                    continue
                if not is_hidden(entry.name):
                    yield f"{folder}/{entry.name}", length
    else:
        for entry in store.get_file_info(fs.FileSelector(name)):
            if not is_hidden(entry.base_name):
                yield f"{folder}/{entry.base_name}", entry.size if entry.is_file else None


def files_below(folder):
    """(path, length) of the files below a folder."""
    folders = [folder]
    while folders:
        for path, length in entries(folders.pop()):
            if length is None:
                folders.append(path)
            else:
                yield path, length


def listed(rows):
    """Arrow batches of (path, length)."""
    while held := list(islice(rows, BATCH_ROWS)):
        paths, lengths = zip(*held)
        columns = [pa.array(paths, pa.string()), pa.array(lengths, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "length"])


def folder_lister(batches):
    """What stands in folders (path), each a row (path, length); folders among it have no length."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            yield from listed(entries(folder))


def subfolder_lister(batches):
    """Rows (path, length) with each folder replaced by the files below it."""
    for batch in batches:
        yield batch.filter(batch.column("length").is_valid())
        for folder in batch.filter(batch.column("length").is_null()).column("path").to_pylist():
            yield from listed(files_below(folder))


class Header(tarfile.TarInfo):
    """A header that tells its archive when the block that ends it was read."""

    @classmethod
    def fromtarfile(cls, tar):
        try:
            return super().fromtarfile(tar)
        except tarfile.EOFHeaderError:
            tar.saw_end = True
            raise


def members(tar):
    """The members in file order, without keeping the headers that were passed.

    The standard library takes a header that is broken, cut or missing for the end of the archive. Here
    only a block of zeros is the end.
    """
    while (member := tar.next()) is not None:
        yield member
        tar.members.clear()
    if not getattr(tar, "saw_end", False):
        raise tarfile.ReadError("a header is broken or the archive is cut off")


def is_damage(error):
    """True for broken content; a failing storage must fail the task, which Spark then retries."""
    return isinstance(error, DAMAGED) or str(error) == "Invalid data stream"


def is_header(block):
    """Whether 512 bytes are a valid header with the usual magic word."""
    if len(block) < tarfile.BLOCKSIZE or block[257:262] != b"ustar":
        return False
    try:
        tarfile.TarInfo.frombuf(block, tarfile.ENCODING, "surrogateescape")
    except tarfile.HeaderError:
        return False
    return True


def is_cuttable(stream):
    """Plain archives can be read in ranges, unless global headers hold for all their members."""
    stream.seek(0)
    head = stream.read(tarfile.BLOCKSIZE)
    return is_header(head) and head[156:157] != tarfile.XGLTYPE


def next_header(stream, start, stop, chunk=LOOK_BACK):
    """Position of the first valid header from a start on, None when none starts before the stop."""
    start = -(-start // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
    stream.seek(start)
    while start < stop and (data := stream.read(chunk)):
        found = data.find(b"ustar", 257)
        while found >= 0:
            at = found - 257
            if at % tarfile.BLOCKSIZE == 0 and is_header(data[at : at + tarfile.BLOCKSIZE]):
                return start + at
            found = data.find(b"ustar", found + 1)
        start += len(data)
    return None


def walk_range(path, start, stop):
    """(first, end): where the first member of a range and the first one behind it start.

    Only headers are read, and for a range in the middle what lies before its first header. The walk starts
    a little early, so that the headers of a long name are taken together. No first member is seen from
    the middle of a long one; no end where the archive ends or is damaged.
    """
    with open_raw(path) as stream:
        if not is_cuttable(stream):
            return (0 if start == 0 else None), None
        at = 0 if start == 0 else next_header(stream, max(0, start - LOOK_BACK), stop)
        if at is None:
            return None, None
        first = None
        try:
            stream.seek(at)
            for member in members(tarfile.open(fileobj=stream, mode="r:", tarinfo=Header)):
                if member.offset >= stop:
                    return first, member.offset if first is not None else None
                if first is None and member.offset >= start:
                    first = member.offset
        except tarfile.TarError:
            pass
        return first, None


def range_walker(batches):
    """(path, start, first, end) of each range (path, start, stop)."""
    for batch in batches:
        rows = [(r["path"], r["start"], *walk_range(r["path"], r["start"], r["stop"])) for r in batch.to_pylist()]
        paths, *numbers = zip(*rows)
        columns = [pa.array(paths, pa.string()), *(pa.array(column, pa.int64()) for column in numbers)]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "start", "first", "end"])


def files(archive, stream, stop=None):
    """(archive, name, text, None) per regular file, and (archive, None, None, error) on damage.

    Without a stop the archive must end with a block of zeros and nothing else may follow; with one, a
    member must start exactly there.
    """
    try:
        tar = tarfile.open(fileobj=stream, mode="r:*", tarinfo=Header)
        for member in members(tar):
            if stop is not None and member.offset >= stop:
                if member.offset != stop:
                    raise tarfile.ReadError("ranges do not meet")
                return
            if member.isreg() and member.size > MEMBER_BYTES:
                yield archive, None, None, f"{member.name}: {member.size} bytes are too many"
            elif member.isreg():
                content = tar.extractfile(member).read()
                yield archive, member.name, content.decode("utf-8", "replace"), None
        # Reading on also verifies the checksum of compressed data, which is at its very end.
        while rest := tar.fileobj.read(BUFFER_BYTES):
            if rest.count(0) != len(rest):
                raise tarfile.ReadError("data follows the end of the archive")
    except (*DAMAGED, OSError) as error:
        if not is_damage(error):
            raise
        yield archive, None, None, f"{type(error).__name__}: {error}"


def files_between(archive, stream, start, stop):
    """The rows of `files` for the members whose headers lie in a range of a plain archive, and for damage there.

    Every member border before the range is found by walking the headers from the start of the archive: 512 bytes
    are read a member, contents are passed over. No stop is the end of the archive.
    """
    size, member = stream.size(), None
    stream.seek(0)
    try:
        plain = tarfile.open(fileobj=stream, mode="r:", tarinfo=Header)
        for member in members(plain):
            if stop is not None and member.offset >= stop:
                return
            if member.offset < start:
                continue
            if member.isreg() and member.size > MEMBER_BYTES:
                yield archive, None, None, f"{member.name}: {member.size} bytes are too many"
            elif member.isreg():
                content = plain.extractfile(member).read()
                yield archive, member.name, content.decode("utf-8", "replace"), None
        if plain.offset < start or (stop is not None and plain.offset >= stop):
            return
        stream.seek(plain.offset)
        while rest := stream.read(BUFFER_BYTES):
            if rest.count(0) != len(rest):
                raise tarfile.ReadError("data follows the end of the archive")
    except (*DAMAGED, OSError) as error:
        if not is_damage(error):
            raise
        # Damage belongs to the range of the member that is cut, else to that of the header that is broken.
        at = plain.offset
        if member is not None and member.offset_data + member.size > size:
            at = member.offset
        if at >= start and (stop is None or at < stop):
            yield archive, None, None, f"{type(error).__name__}: {error}"


def to_batches(rows):
    """Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or "")
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield to_batch(held)
            held, size = [], 0
    if held:
        yield to_batch(held)


def to_batch(rows):
    columns = [pa.array(column, pa.string()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, names=["archive", "file_name", "raw_txt", "error"])


def block_reader(batches):
    """Files of archive blocks (path, start, stop), read where they are stored."""

    def rows():
        for batch in batches:
            for block in batch.to_pylist():
                with open_path(block["path"]) as stream:
                    stream.seek(block["start"])
                    yield from files(block["path"], stream, block["stop"])

    return to_batches(rows())


def read_blobs(batches):
    """Files of archives held in a binary column (path, content)."""

    def rows():
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield from files(path.as_py(), pa.BufferReader(content.as_buffer()))

    return to_batches(rows())
