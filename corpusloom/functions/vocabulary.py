"""Word lists, patterns and selectors that results depend on.

They are defaults; every function that uses one takes another as an argument.
"""

# Fixed values, in their natural order.

COMMON_WORDS = [
    "dan", "yang", "untuk", "dengan", "pada", "dari", "adalah", "dalam", "ini", "itu", "akan", "tidak", "atau", "juga", "telah", "dapat", "oleh",
    "sebuah", "serta", "antara", "bahwa", "lebih", "karena", "seperti", "ada", "mereka", "harus", "bisa", "sudah", "tersebut", "secara", "maka",
    "tentang", "setiap", "sangat", "berdasarkan", "merupakan", "siswa", "pembelajaran", "pelajaran", "materi", "kurikulum",
]

TARGET_KEYWORDS = [
    "Pendidikan Indonesia",
    "Sekolah Rakyat",
    "Sekolah Dasar",
    "Sekolah Menengah Pertama",
    "Sekolah Menengah Atas",
    "Sekolah Menengah Kejuruan",
    "Madrasah",
    "Kurikulum Nasional",
    "Kurikulum Merdeka",
    "Kurikulum 2013",
    "Capaian Pembelajaran",
    "Alur Tujuan Pembelajaran",
    "Modul Ajar",
    "Silabus",
    "RPP",
    "Rencana Pelaksanaan Pembelajaran",
    "Kemampuan Kognitif",
    "Kognitif Siswa",
    "Ujian Nasional",
    "Asesmen Nasional",
    "Asesmen Kompetensi Minimum",
    "Asesmen Formatif",
    "Asesmen Sumatif",
    "Evaluasi Pembelajaran",
    "Soal Ujian",
    "Matematika",
    "Fisika",
    "Kimia",
    "Biologi",
    "Sains",
    "IPA",
    "Informatika",
    "Koding",
    "Ekonomi",
    "Sejarah",
    "Sosiologi",
    "Geografi",
    "IPS",
    "Ilmu Pengetahuan Sosial",
    "Pendidikan Kewarganegaraan",
    "PKN",
    "PPKN",
    "Sejarah Indonesia",
    "Bahasa Indonesia",
    "Bahasa Inggris",
    "Pancasila",
    "Profil Pelajar Pancasila",
    "Pendidikan Karakter",
    "Nasionalisme",
    "Kementerian Pendidikan",
    "Kemdikbud",
    "Kemendikbudristek",
    "Kemdikdasmen",
    "Kemdiktisaintek",
    "Kemensos Sekolah Rakyat",
    "Badan Standar Kurikulum dan Asesmen Pendidikan",
    "BSKAP",
    "Pusat Kurikulum dan Pembelajaran",
    "Soal Mudah SD SMP SMA",
    "Soal Menengah SD SMP SMA",
    "Soal Sulit SD SMP SMA",
    "Olimpiade Sains Nasional (OSN) SD SMP SMA",
    "Latihan Soal",
    "Bank Soal",
    "Pembahasan Soal",
    "Kunci Jawaban",
    "Materi Pelajaran",
    "Buku Teks",
    "Bahan Ajar",
    "Pembelajaran",
    "Guru Penggerak",
    "Projek Penguatan Profil Pelajar Pancasila",
    "socratic",
    "teknik pengajaran",
    "scaffolding",
    "strategi pengajaran",
    "feedback untuk siswa",
    "growth mindset",
    "motivasi belajar",
    "strategi belajar",
    "kesulitan belajar",
    "pembelajaran kolaboratif",
    "pembelajaran efektif",
    "pembelajaran eksperimen",
    "pembelajaran aktif",
    "teknik pomodoro",
    "belajar efektif",
    "metode belajar efektif",
    "teknik belajar efisien",
    "strategi belajar efektif",
    "metode mencatat cornell",
    "mind mapping",
    "manajemen waktu",
    "strategi meningkatkan fokus",
    "burnout",
    "kecemasan",
    "adaptasi siswa",
    "kesehatan mental pelajar",
    "stres akademik",
    "motivasi siswa",
    "menunda pekerjaan",
    "beasiswa",
    "rekomendasi beasiswa",
    "motivational interviewing",
    "komunikasi asertif",
    "asertif",
    "active listening",
    "empati dalam konseling",
    "empatik communication",
    "empati",
    "komunikasi empatik",
    "pendekatan persuasif",
    "validasi emosi",
    "validasi emosi siswa",
    "konseling realitas",
    "konseling siswa",
    "konseling",
    "motivasi",
    "kode etik",
    "batasan profesional",
    "penanganan krisis",
    "pertolongan psikologis",
    "pencegahan perundungan",
    "etika komunikasi",
    "kedaruratan mental",
]

SCIENCE_TERMS = [
    "materi sains",
    "pelajaran ipa",
    "ilmu pengetahuan alam",
    "materi fisika",
    "arus listrik",
    "listrik statis",
    "listrik dinamis",
    "tegangan listrik",
    "hambatan listrik",
    "rangkaian listrik",
    "medan magnet",
    "konsep energi",
    "konsep gaya",
    "konsep gerak",
    "konsep kecepatan",
    "konsep percepatan",
    "konsep massa",
    "konsep gravitasi",
    "konsep tekanan",
    "konsep fluida",
    "gelombang mekanik",
    "frekuensi gelombang",
    "amplitudo gelombang",
    "optik geometri",
    "cahaya tampak",
    "lensa cembung",
    "gelombang bunyi",
    "energi termal",
    "konsep suhu",
    "energi kalor",
    "konsep termodinamika",
    "materi kimia",
    "struktur atom",
    "struktur molekul",
    "unsur kimia",
    "senyawa kimia",
    "reaksi kimia",
    "materi stoikiometri",
    "asam basa",
    "nilai ph",
    "larutan kimia",
    "ikatan kimia",
    "tabel periodik",
    "materi biologi",
    "konsep genetika",
    "molekul dna",
    "struktur sel",
    "sel hewan",
    "sel tumbuhan",
    "jaringan tubuh",
    "organ tubuh",
    "konsep ekologi",
    "teori evolusi",
    "mikroorganisme patogen",
    "bakteri patogen",
    "virus patogen",
    "sistem pencernaan",
    "sistem pernapasan",
    "sistem peredaran darah",
    "materi matematika",
    "materi statistika",
    "materi probabilitas",
    "materi peluang",
    "konsep aljabar",
    "konsep geometri",
    "konsep trigonometri",
    "konsep kalkulus",
    "konsep integral",
    "konsep turunan",
    "konsep limit",
    "konsep logaritma",
    "konsep eksponen",
    "konsep persamaan",
    "konsep fungsi",
    "konsep vektor",
    "konsep matriks",
    "tabel data",
    "grafik fungsi",
    "diagram batang",
    "metode eksperimen",
    "metode percobaan",
    "kegiatan praktikum",
    "ruang laboratorium",
    "metode ilmiah",
    "uji hipotesis",
    "hasil pengamatan",
    "analisis data",
    "olimpiade sains",
    "osn sains",
    "ilmu pengetahuan sosial",
    "materi ips",
    "ilmu ekonomi",
    "materi ekonomi",
    "konsep permintaan",
    "konsep penawaran",
    "ilmu sejarah",
    "materi sejarah",
    "sejarah indonesia",
    "ilmu sosiologi",
    "materi sosiologi",
    "ilmu geografi",
    "materi geografi",
    "pendidikan kewarganegaraan",
    "pendidikan pancasila",
    "bahasa indonesia",
    "bahasa inggris",
    "kalimat efektif",
    "struktur teks",
    "teks eksplanasi",
    "teks prosedur",
    "analisis cerpen",
    "seni budaya",
]

UI_NOISE = [
    r"^\s*\*?\*?(masuk|login|log in|sign in|sign up|daftar|register)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(beranda|home|menu|navigasi|navigation)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(cari|search|telusuri)\s*\.{0,3}\s*\*?\*?\s*$",
    r"^\s*\*?\*?(bagikan|share|tweet|facebook|whatsapp|telegram|copy link)\s*\*?\*?\s*$",
    r"^\s*(skip to (?:content|main)|lewati ke konten|langsung ke konten)",
    r"^\s*(copyright|hak cipta|©|\(c\))\s",
    r"^\s*\*?\*?(baca juga|baca selengkapnya|read more|selengkapnya|lihat semua|see all)\s*:?\s*\*?\*?",
    r"^\s*\*?\*?(iklan|advertisement|sponsored|promoted|promo)\s*\*?\*?\s*$",
    r"^\s*(loading|memuat|please wait|tunggu)\.{0,3}\s*$",
    r"^\s*\*?\*?(kembali ke atas|back to top|↑|⬆)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(hubungi kami|contact us|kontak)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(tentang kami|about us|kebijakan privasi|privacy policy|syarat|terms)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(download aplikasi|unduh aplikasi|get the app)\s*\*?\*?\s*$",
    r"^\s*\|.*\|.*\|.*\|\s*$",
    r"^\s*\*?\*?(subscribe|berlangganan|newsletter|whatsapp)\s*\*?\*?\s*$",
    r"^\s*follow us",
    r"^\s*ikuti kami",
    r"^\s*\*?\*?\d+\s*(komentar|comments?)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(prev|next|sebelumnya|selanjutnya|older|newer)\s*(post|artikel)?\s*\*?\*?\s*$",
    r"^\s*_?(search|chevron_left|chevron_right|arrow_drop_down|arrow_back|arrow_forward|menu|close|expand_more|expand_less|check|star|favorite|thumb_up|thumb_down|visibility|edit|delete|add|remove|settings|info|warning|error|help|person|people|school|book|calendar|clock|phone|email|location|home|work)_?\s*$",
    r"^\s*_{1,2}[a-z_]+_{1,2}\s*$",
    r"^\s*slide\s+\d+\s+(of|dari)\s+\d+",
    r"^\s*\d+\s*/\s*\d+\s*$",
    r"^\s*(page not found|404|halaman tidak ditemukan|oops|error|maaf.*tidak ditemukan)",
    r"^\s*(the page you|halaman yang anda)\s",
    r"^\s*(beranda|home)\s*[>»›/]\s*",
    r"^(\s*\w+\s*[>»›/]){2,}",
    r"^\s*nib[\s:]*\d",
    r"^\s*(all rights reserved|hak cipta dilindungi)",
    r"^\s*powered by\s",
    r"^\s*designed by\s",
    r"^\s*(ketentuan layanan|terms of service|terms & conditions)",
    r"^\s*(available on|tersedia di)\s*(google play|app store|play store)",
    r"^\s*(get it on|download on)\s",
    r"^\s*\*?\*?(facebook|twitter|instagram|youtube|linkedin|tiktok)\s*\*?\*?\s*$",
    r"^\s*(we use cookies|kami menggunakan cookie|this site uses cookies)",
    r"^\s*(masukkan|enter|input)\s*(email|password|kata sandi|nama|name|username)",
    r"^\s*(lupa password|forgot password|lupa kata sandi)",
    r"^\s*(belum punya akun|don't have an account|sudah punya akun|already have)",
    r"^\s*\*?\*?(lihat|view|tampilkan|show)\s+(selengkapnya|semua|more|all|arsip|detail)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(pelajari selengkapnya|learn more|read full|baca lengkap)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(mulai sekarang|start now|coba sekarang|try now|daftar sekarang)\s*\*?\*?\s*$",
    r"^\s*\*?\*?(gabung|join)\s",
    r"^\s*(open main menu|toggle navigation|main menu|menu utama)",
]

BUTTON_WORDS = [
    "login",
    "masuk",
    "daftar",
    "register",
    "sign up",
    "sign in",
    "home",
    "beranda",
    "menu",
    "search",
    "cari",
    "telusuri",
    "share",
    "bagikan",
    "tweet",
    "print",
    "cetak",
    "salin",
    "prev",
    "next",
    "previous",
    "close",
    "tutup",
    "buka",
    "subscribe",
    "ok",
    "cancel",
    "batal",
    "submit",
    "filter",
    "kirim",
    "send",
    "reset",
    "clear",
    "hapus",
    "urutkan",
    "save",
    "simpan",
    "edit",
    "delete",
    "remove",
    "tambah",
    "profil",
    "profile",
    "akun",
    "account",
    "pengaturan",
    "settings",
    "unduh",
    "download",
    "upload",
    "unggah",
    "arsip",
    "archive",
    "kelas",
    "mapel",
    "materi",
    "modul",
    "topik",
    "kategori",
    "terbaru",
    "terlama",
    "populer",
    "trending",
    "semua",
    "sd",
    "smp",
    "sma",
    "smk",
    "paud",
    "tk",
    "overview",
    "ringkasan",
    "layanan",
    "service",
    "services",
    "berita",
    "artikel",
    "blog",
    "galeri",
    "gallery",
    "foto",
    "video",
    "livestream",
    "podcast",
    "webinar",
    "bantuan",
    "help",
    "faq",
    "panduan",
    "guide",
    "lainnya",
    "more",
    "lain",
    "other",
    "id",
    "en",
    "bahasa",
    "english",
    "indonesia",
]

NAV_LIKE = [
    r"^kelas\s+\d",
    r"^(sd|smp|sma|smk)\s*$",
    r"^bab\s+\d",
    r"^(semester|sem)\s+\d",
    r"^(tema|subtema)\s+\d",
    r"^halaman\s+\d",
    r"^\d+\s*[-–]\s*\d+\s*$",
    r"^\d+\s+(menit|jam|hari|minggu|bulan|tahun)\s*(lalu|yang lalu)?\s*$",
    r"^(oleh|by|penulis|author|editor|reporter|kontributor|foto|sumber)\s*:?\s*\w",
    r"^(tag|label|kategori|category)\s*:",
    r"^(dibaca|views?|dilihat)\s*:?\s*\d",
    r"^(updated?|diperbarui|dipublikasi|published|terbit)\s*:?\s",
    r"^(share|bagikan)\s*:",
    r"^\(\d+\)\s*$",
    r"^img\s+",
    r"^gambar\s+\d",
    r"^(foto|image|ilustrasi|infografis)\s*:",
    r"^\[.*\]\s*$",
    "^pindah ke bilah sisi",
    "^(mode ulang tahun|baby globe)",
    "^pelajari mode ulang tahun",
    "^halaman ini selalu menggunakan",
    "^the content is as wide as",
    r"^warna \(beta\)",
    "^ikuti wikipedia",
    "^gulingkan subbagian",
    "^(dari wikipedia|from wikipedia)",
    "^langsung ke konten",
    r"^(sembunyikan|tampilkan)\s+(subbagian|bagian|daftar)",
    r"^(artikel utama|main article)\s*:",
    r"^(lihat pula|see also)\s*$",
    r"^(pranala luar|external links)\s*$",
    r"^(referensi|references)\s*$",
    r"^(catatan kaki|footnotes)\s*$",
    r"^diperoleh dari\s",
    r"^diposkan oleh\s",
    r"^posted by\s",
    "^leave a comment",
    "^posting komentar",
    r"^\d+ comment",
    r"^read more\s*[»›>]",
    r"^baca selengkapnya\s*[»›>]",
    r"^loading\s*\.{0,3}\s*$",
    "^[A-Z][a-z]+[A-Z][a-z]+[A-Z]",
    r"^facebook\s+instagram\s+twitter",
    "^follow us on",
    "^share (this|article)",
    r"^\w+,\s+\w+\s+\d{1,2},\s+\d{4}\s*$",
    r"^\d{1,2}\s+\w+\s+\d{4}\s*$",
    r"^\d{1,2}/\d{1,2}/\d{4}\s*$",
    r"^\w+\s+\d{1,2},\s+\d{4}\s*$",
    r"^admin\s+\d",
    r"^(no|nib|npwp)[\s.:]+\d",
    "^selamat datang",
    "^masuk ke akun",
    "^memulihkan kata sandi",
    "^(sebuah )?kata sandi akan",
    "^daftar keanggotaan",
    "^dengan mendaftar.*anda dianggap",
    r"^headlines?\s*:?\s*$",
]

ERROR_SIGNALS = [
    "page not found",
    "404",
    "halaman tidak ditemukan",
    "the page you requested",
    "this page doesn't exist",
    "halaman yang anda cari tidak ditemukan",
]

AD_SIGNALS = [
    "daftar sekarang",
    "berlangganan",
    "langganan",
    "beli paket",
    "harga paket",
    "gratis trial",
    "download aplikasi",
    "unduh aplikasi",
    "promo ",
    "diskon ",
    "cashback",
    "hubungi kami",
    "hubungi sales",
    "free trial",
    "start free",
    "sign up",
    "testimoni",
    "gabung sekarang",
    "coba gratis",
    "mulai belajar gratis",
    "paket belajar",
    "fitur premium",
]

SEARCH_QUERIES = [
    "site:go.id kurikulum merdeka materi pelajaran",
    "site:go.id modul ajar SD SMP SMA",
    "site:go.id capaian pembelajaran kurikulum",
    "site:go.id asesmen nasional AKM",
    "site:go.id ujian nasional soal",
    "site:go.id profil pelajar pancasila",
    "site:go.id guru penggerak kurikulum",
    "site:go.id silabus RPP kurikulum merdeka",
    "site:go.id pendidikan dasar menengah",
    "site:go.id buku teks pelajaran",
    "site:go.id peraturan kurikulum pendidikan",
    "site:kemdikdasmen.go.id sekolah rakyat kurikulum",
    "site:kemdiktisaintek.go.id pendidikan tinggi riset",
    "site:bskap.kemdikdasmen.go.id standar kurikulum asesmen",
    "site:ristekbrin.go.id penelitian pendidikan",
    "site:ac.id kurikulum merdeka penelitian",
    "site:ac.id jurnal pendidikan matematika",
    "site:ac.id jurnal pendidikan sains fisika kimia biologi",
    "site:ac.id jurnal pendidikan bahasa Indonesia",
    "site:ac.id jurnal pendidikan IPS ekonomi sejarah",
    "site:ac.id asesmen kognitif siswa",
    "site:ac.id modul ajar kurikulum",
    "site:ac.id pendidikan karakter pancasila",
    "site:ac.id evaluasi pembelajaran sekolah",
    "site:ac.id taksonomi Bloom HOTS pendidikan",
    "site:sch.id materi pelajaran kurikulum merdeka",
    "site:sch.id soal ujian pembahasan",
    "site:sch.id modul ajar guru",
    "site:sch.id RPP silabus kurikulum",
    "site:zenius.net materi pelajaran",
    "site:zenius.net soal pembahasan matematika fisika",
    "site:ruangguru.com materi pelajaran kurikulum",
    "site:ruangguru.com soal latihan pembahasan",
    "site:quipper.com materi pelajaran Indonesia",
    "site:kelaspintar.id materi kurikulum merdeka",
    "site:utbk.id soal pembahasan",
    "site:kompas.com pendidikan kurikulum merdeka sekolah",
    "site:kompas.id pendidikan kurikulum Indonesia",
    "site:detik.com pendidikan kurikulum merdeka sekolah",
    "site:tempo.co pendidikan kurikulum Indonesia",
    "site:cnnindonesia.com education pendidikan",
    "site:cnbcindonesia.com education pendidikan",
    "site:republika.co.id pendidikan kurikulum sekolah",
    "site:tribunnews.com pendidikan sekolah kurikulum",
    "site:antaranews.com pendidikan sekolah Indonesia",
    "site:suara.com pendidikan sekolah kurikulum",
    "site:kontan.co.id pendidikan sekolah vokasi",
    "site:bisnis.com pendidikan sekolah Indonesia",
    "site:katadata.co.id pendidikan riset Indonesia",
    "site:nu.or.id pendidikan islam kurikulum",
    "site:muhammadiyah.or.id pendidikan sekolah",
    "\"Kurikulum Merdeka\" materi pelajaran Indonesia",
    "\"Kurikulum Merdeka\" modul ajar SD Indonesia",
    "\"Kurikulum Merdeka\" modul ajar SMP Indonesia",
    "\"Kurikulum Merdeka\" modul ajar SMA Indonesia",
    "\"Kurikulum Nasional\" Indonesia pendidikan",
    "\"Capaian Pembelajaran\" kurikulum merdeka Indonesia",
    "\"Alur Tujuan Pembelajaran\" ATP kurikulum merdeka",
    "\"Sekolah Rakyat\" pendidikan Indonesia",
    "rencana pelaksanaan pembelajaran kurikulum merdeka",
    "\"modul ajar\" guru penggerak kurikulum merdeka",
    "\"Kemdikdasmen\" kurikulum pendidikan",
    "\"Kemdiktisaintek\" pendidikan tinggi",
    "\"Ujian Nasional\" soal pembahasan Indonesia",
    "\"Asesmen Nasional\" soal AKM Indonesia",
    "\"Asesmen Kompetensi Minimum\" AKM soal pembahasan",
    "\"bank soal\" ujian nasional Indonesia",
    "latihan soal ujian SD SMP SMA Indonesia",
    "soal dan pembahasan ujian nasional Indonesia",
    "soal AKM literasi numerasi pembahasan",
    "materi matematika SD kurikulum merdeka Indonesia",
    "materi matematika SMP kurikulum merdeka",
    "materi matematika SMA kurikulum merdeka",
    "soal matematika SMP pembahasan lengkap",
    "soal matematika SMA pembahasan lengkap",
    "olimpiade matematika Indonesia OSN soal pembahasan",
    "rumus matematika SMA lengkap Indonesia",
    "materi fisika SMA kurikulum merdeka Indonesia",
    "soal fisika SMA pembahasan lengkap",
    "olimpiade fisika Indonesia soal pembahasan",
    "rumus fisika SMA lengkap",
    "materi kimia SMA kurikulum merdeka Indonesia",
    "soal kimia SMA pembahasan lengkap",
    "olimpiade kimia Indonesia soal pembahasan",
    "materi biologi SMA kurikulum merdeka Indonesia",
    "materi IPA biologi SMP kurikulum merdeka",
    "soal biologi SMA pembahasan lengkap",
    "olimpiade biologi Indonesia soal pembahasan",
    "materi ekonomi SMA kurikulum merdeka Indonesia",
    "soal ekonomi SMA pembahasan",
    "materi sejarah Indonesia SMA kurikulum merdeka",
    "soal sejarah Indonesia SMA pembahasan",
    "materi sosiologi SMA kurikulum merdeka Indonesia",
    "materi geografi SMA kurikulum merdeka Indonesia",
    "materi IPS SMP kurikulum merdeka Indonesia",
    "materi PPKN kurikulum merdeka Indonesia",
    "materi pendidikan kewarganegaraan SD SMP SMA",
    "soal PPKN Pancasila pembahasan",
    "\"Pendidikan Pancasila\" materi kurikulum merdeka",
    "materi bahasa Indonesia SD kurikulum merdeka",
    "materi bahasa Indonesia SMP kurikulum merdeka",
    "materi bahasa Indonesia SMA kurikulum merdeka",
    "soal bahasa Indonesia pembahasan ujian",
    "materi bahasa Inggris SMP kurikulum merdeka",
    "materi bahasa Inggris SMA kurikulum merdeka",
    "soal bahasa Inggris SMP SMA pembahasan",
    "soal pilihan ganda SD kelas 4 5 6 pembahasan Indonesia",
    "soal pilihan ganda SMP kelas 7 8 9 pembahasan Indonesia",
    "soal pilihan ganda SMA kelas 10 11 12 pembahasan",
    "soal olimpiade sains nasional OSN Indonesia",
    "soal HOTS matematika SMA pembahasan",
    "soal sulit olimpiade matematika fisika Indonesia",
    "contoh soal mudah menengah sulit SMA pembahasan",
    "kemampuan kognitif siswa pendidikan Indonesia",
    "pembelajaran berdiferensiasi kurikulum merdeka",
    "pendidikan karakter nasionalisme siswa Indonesia",
    "projek penguatan profil pelajar Pancasila P5",
    "jurnal pendidikan Indonesia kurikulum merdeka",
    "jurnal penelitian pendidikan matematika Indonesia",
    "jurnal pendidikan sains Indonesia",
    "jurnal asesmen evaluasi pendidikan Indonesia",
    "garuda.kemdikbud.go.id jurnal pendidikan",
    "sinta.kemdikbud.go.id pendidikan",
    "neliti.com pendidikan Indonesia",
]

BLOCKED_DOMAINS = [
    "google.com", "google.co.id", "www.google.com", "www.google.co.id", "bing.com", "www.bing.com", "duckduckgo.com", "html.duckduckgo.com",
    "yahoo.com", "search.yahoo.com", "youtube.com", "www.youtube.com", "m.youtube.com", "facebook.com", "www.facebook.com", "m.facebook.com",
    "twitter.com", "x.com", "instagram.com", "www.instagram.com", "tiktok.com", "www.tiktok.com", "linkedin.com", "www.linkedin.com", "pinterest.com",
    "reddit.com", "www.reddit.com", "quora.com", "www.quora.com", "play.google.com", "apps.apple.com", "amazon.com", "www.amazon.com", "shopee.co.id",
    "tokopedia.com", "bukalapak.com", "lazada.co.id", "blibli.com", "jd.id", "en.wikipedia.org", "en.wikibooks.org", "britannica.com",
    "www.britannica.com", "khanacademy.org", "www.khanacademy.org", "coursera.org", "www.coursera.org", "edx.org", "www.edx.org", "medium.com",
    "scribd.com", "www.scribd.com", "slideshare.net", "www.slideshare.net", "academia.edu", "www.academia.edu", "researchgate.net",
    "www.researchgate.net", "ms.wikipedia.org", "min.wikipedia.org", "su.wikipedia.org", "jv.wikipedia.org", "ban.wikipedia.org", "ace.wikipedia.org",
    "bug.wikipedia.org", "map-bms.wikipedia.org", "de.wikipedia.org", "fr.wikipedia.org", "es.wikipedia.org", "ja.wikipedia.org", "zh.wikipedia.org",
    "pt.wikipedia.org", "ru.wikipedia.org", "ar.wikipedia.org", "hi.wikipedia.org", "web.archive.org",
]

BLOCKED_URL_PARTS = [
    "/w/index.php", "action=edit", "veaction=edit", "action=history", "oldid=", "diff=", "/wiki/Special:", "/wiki/Kategori:", "/wiki/Category:",
    "/wiki/Pembicaraan:", "/wiki/Talk:", "/wiki/Pengguna:", "/wiki/User:", "/wiki/Wikipedia:", "/wiki/Portal:", "/wiki/Templat:", "/wiki/Template:",
    "/wiki/Berkas:", "/wiki/File:", "/wiki/Modul:", "/wiki/Module:", "/wiki/Istimewa:", "/wiki/Halaman_pembicaraan:", "printable=yes",
    "mobileaction=", "/login", "/register", "/signup", "/auth/", "/api/", "/feed/", "/rss", "wp-json/", "bayar.", "/bayar", "/pricing", "/harga",
    "/paket", "/package/", "/checkout", "/payment", "/subscribe", "/subscription", "/langganan", "/promo", "/diskon", "/voucher", "voucher_serial=",
    "/ruangbelajar", "/ruanguji", "/ruangles", "/privat", "/for-kids", "/skill-academy", "/roboguru", "pengajar.", "referralcookiesid=",
    "utm_source=", "utm_medium=", "utm_campaign=", "/karir", "/career", "/jobs", "/lowongan", "/about-us", "/tentang-kami", "/contact", "/hubungi",
    "/terms", "/privacy", "/kebijakan-privasi", "/syarat-ketentuan",
]

SKIP_EXTENSIONS = [
    ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".rar", ".7z", ".tar", ".gz", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp",
    ".mp3", ".mp4", ".avi", ".mov", ".wav", ".exe", ".msi", ".dmg", ".apk",
]

EDU_URL_PARTS = [
    "kurikulum", "pendidikan", "pelajaran", "belajar", "modul", "sekolah", "guru", "siswa", "materi", "ajar", "ujian", "asesmen", "soal",
    "pembahasan", "latihan", "olimpiade", "bank-soal", "edukasi", "pembelajaran", "evaluasi", "kognitif", "pedagogik", "sekolah-dasar",
    "sekolah-menengah", "matematika", "fisika", "kimia", "biologi", "ekonomi", "sosiologi", "geografi", "ppkn", "pkn", "kewarganegaraan",
    "bahasa-indonesia", "bahasa-inggris", "sains", "dikbud", "diknas", "dikdasmen", "dikti", ".sch.id", "zenius", "ruangguru", "quipper", "pahamify",
    "roboguru", "gurusiana", "indonesiana", "gurusd", "operatorsekolah", "sekolahdasar", "ainamulyana", "gurune", "kangmartho", "sejutaguru",
    "informasiguru", "pak-anang", "kangdidik", "saling-sapa", "koranedukasi", "pintar.tanotofoundation", "inovasi.or.id", "pspk.id", "/edu",
    "edukasi.", "/pendidikan",
]

ACCEPTED_HOST_PARTS = [
    ".go.id",
    ".ac.id",
    ".sch.id",
    "kemdikbud",
    "kemendikbud",
    "dikdasmen",
    "belajar.id",
    "gurusiana.id",
    "indonesiana.id",
    "gurusd.web.id",
    "operatorsekolah.com",
    "sekolahdasar.net",
    "koranedukasi.id",
    "pspk.id",
    "inovasi.or.id",
    "pintar.tanotofoundation.org",
]

TRACKING_PARAMS = [
    "fbclid", "gclid", "yclid", "igshid", "mc_cid", "mc_eid", "ref", "ref_src",
]

CONTENT_SELECTORS = [
    "article",
    "main article",
    "main",
    "[role='main']",
    ".read__content",
    ".post-content",
    ".entry-content",
    ".article-body",
    ".article-content",
    ".content-area",
    ".td-post-content",
    ".post-body",
    "#content",
]

JOURNAL_WORDS = [
    "pendidikan", "pembelajaran", "kurikulum", "siswa", "guru", "sekolah", "mengajar", "asesmen", "evaluasi", "pedagogi", "didaktik", "literasi",
    "numerasi", "karakter", "pancasila",
]

JOURNAL_DOMAINS = [
    "garuda.kemdikbud.go.id", "sinta.kemdikbud.go.id", "neliti.com", "repository.ui.ac.id", "repository.ugm.ac.id", "repository.itb.ac.id",
    "repository.uny.ac.id", "eprints.uny.ac.id", "journal.uny.ac.id", "ejournal.ut.ac.id", "jurnal.upi.edu", "journal.um.ac.id",
]

CLEANER_NOISE = [
    r"^Foto\s*\d*\.?.*",
    r"^Dok\..*",
    r"^\(.*\)$",
    r"^_\(.*\)_$",
    "^Pemaparan Materi.*",
    "^From Data to Action.*",
    r"^Jakarta, \d+ [A-Za-z]+ \d+.*",
    "^The Second meeting.*",
    "^.*assessments? are.*",
    "^Copyright ©.*",
    "^Share this.*",
    "^Baca juga.*",
    "^Tags:.*",
    "^Kategori:.*",
]

CLEANER_SELECTORS = [
    "article", ".post-content", ".entry-content", ".article-body", ".content-area", ".field--name-body", ".td-post-content", ".kt-entry-content",
    "#content", "main", ".post-detail", ".berita-detail", "body",
]

CLEANER_WORDS = [
    "kurikulum",
    "sekolah",
    "siswa",
    "guru",
    "pembelajaran",
    "pendidikan",
    "asesmen",
    "murid",
    "kelas",
    "materi",
    "ujian",
    "sekolah rakyat",
    "kemendikdasmen",
    "kemdiktisaintek",
    "merdeka",
    "pelajar",
]

#: Level of education by pattern, the first that is found.
LEVELS = [
    ("SD", r"\b(sd|sekolah\s+dasar|tematik|kelas\s+[1-6])\b"),
    ("SMP", r"\b(smp|sekolah\s+menengah\s+pertama|menengah\s+pertama|kelas\s+[7-9])\b"),
    ("SMA", r"\b(sma|smk|sekolah\s+menengah\s+atas|menengah\s+atas|kelas\s+1[0-2])\b"),
]
OTHER_LEVEL = "Umum"

#: Text that is taken out of lines.
URL_TEXT = r"https?://\S+"
EMAIL_TEXT = r"\S+@\S+\.\S+"
PHONE_TEXT = r"(?:(?:\+62|62|0)\s*[-.]?\s*\d{2,4}[-.\s]?\d{3,4}[-.\s]?\d{3,4})"
ICON_TEXT = r"_{1,2}[a-z][a-z_]*_{1,2}"
DATELINE_CITIES = "JAKARTA|BANDUNG|SURABAYA|YOGYAKARTA|MEDAN|SEMARANG|MAKASSAR|DENPASAR|SOLO|BOGOR"
DATELINE_OUTLETS = r"KOMPAS\.com|TEMPO\.CO|detik\.com|CNN Indonesia|ANTARA|REPUBLIKA\.co\.id|Bisnis\.com|JPNN\.com|Liputan6\.com|Okezone"
JOINED_CAMEL = r"(?:[A-Z][a-z]+){4,}$"
LIST_LINE = r"(?:\w{2,20}\s*[|·•►▸▹▶→»›/\\,]\s*){3,}"
REPUBLIKA_DATELINE = r"^REPUBLIKA\.CO\.ID,\s+[A-Z\s]+[-–—]+\s*"

#: Wording of site queries; {kw} is a phrase, {site} a domain.
QUERY_TEMPLATES = [
    "materi sma {kw} site:{site}",
    "materi smp {kw} site:{site}",
    "materi sd {kw} site:{site}",
    "contoh soal {kw} site:{site}",
    "bank soal {kw} site:{site}",
    "kurikulum {kw} site:{site}",
    "asesmen {kw} site:{site}",
    "{kw} site:{site}",
]

#: First URLs of a focused run, by the end of its domain.
SEEDS = {
    "kompas.com": ["https://www.kompas.com/edu", "https://www.kompas.com/edu/", "https://edukasi.kompas.com/", "https://www.kompas.com/"],
    "detik.com": ["https://www.detik.com/edu", "https://www.detik.com/edu/", "https://www.detik.com/edu/sekolah", "https://www.detik.com/edu/perguruan-tinggi", "https://www.detik.com/edu/edutainment"],
    "ruangguru.com": ["https://www.ruangguru.com/blog", "https://www.ruangguru.com/blog/"],
    "liputan6.com": ["https://www.liputan6.com/news", "https://www.liputan6.com/education", "https://www.liputan6.com/"],
    "republika.co.id": ["https://news.republika.co.id/berita/nasional/pendidikan", "https://republika.co.id/berita/nasional/umum", "https://republika.co.id/"],
    "quipper.com": ["https://www.quipper.com/id/blog/", "https://www.quipper.com/id/blog/materi-belajar/", "https://www.quipper.com/id/blog/tips-trick/"],
    "zenius.net": ["https://www.zenius.net/blog/", "https://www.zenius.net/blog/category/materi-belajar/", "https://www.zenius.net/blog/category/tips-belajar/"],
}
